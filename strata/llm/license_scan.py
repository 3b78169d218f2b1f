"""License scan: ordered signature rules over whole texts, in DataFrame functions.

A text is normalised to words with one blank between them.  Phrases are counted
at every place where their words stand.  Signature rules are then tried in texts
that hold an anchor, each rule only where its own keyword occurs.  Matches are word
intervals; one that lies within another is suppressed, and of equal intervals the rule
with the smaller priority number stands (then the label's order).

Defined results: null and wordless texts have no words, no matches, null places, empty
labels and score 0; repeated rows get equal results; an empty table gives an empty
result; only ``doc_id`` and ``text`` are read, other columns may have any name.
Matches are placed and compared within one row; their running sums are taken in chunks, so
the work of 64,000 matches in one text is seconds, not minutes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower
from .license_rules import ANCHORS, RULES, Rule

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
LINE = "__ls_line"


def normal_line(text: Column) -> Column:
    """Lower-cased words, each with one blank before it, and one at the end."""
    return F.regexp_replace(F.concat(F.lit(" "), ascii_lower(F.coalesce(text, F.lit(""))), F.lit(" ")), NOT_WORD, " ")


def blanks(col: Column) -> Column:
    return F.octet_length(col) - F.octet_length(F.replace(col, F.lit(" "), F.lit("")))


def phrase_places(line: Column, phrase: str) -> Column:
    """A struct ``n, first, last`` of the places where the phrase's words stand."""
    at, size = f" {phrase} ", len(phrase.split())
    # a lookahead: two places may share the blank between them
    return F.when(
        F.contains(line, F.lit(at)),
        F.struct(
            F.regexp_count(line, F.lit(f"(?={at})")).cast("long").alias("n"),
            blanks(F.substring_index(line, at, 1)).cast("long").alias("first"),
            (blanks(line) - 1 - blanks(F.substring_index(line, at, -1)) - size).cast("long").alias("last"),
        ),
    )


def rules_array(rules: list[Rule]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(r.keyword).alias("keyword"),
                F.lit(f" (?:{r.regex})(?= )").alias("regex"),
                F.lit(r.priority).alias("priority"),
                F.lit(r.label).alias("label"),
                F.lit(r.weight).alias("weight"),
            )
            for r in rules
        ]
    )


CHUNK = 128  # matches that are added up together


def detections(rules: list[Rule]) -> Column:
    """The standing labels and the largest weight, as a struct, of the column LINE."""
    words = "(octet_length({0}) - octet_length(replace({0}, ' ', '')))".format
    # a match begins with its blank: blanks before a match are the words before it.  Words before each match
    # are running sums; they are taken within chunks and over chunks, as an array can't carry one cheaply
    intervals = f"""
        flatten(transform(filter(__ls_rules, r -> contains({LINE}, r.keyword)), r ->
          flatten(transform(
            array(filter(zip_with(split({LINE}, r.regex), regexp_extract_all({LINE}, r.regex, 0),
                                  (g, h) -> named_struct('gap', {words("g")}, 'hit', {words("h")})), z -> z.hit IS NOT NULL)),
            m -> flatten(transform(
              array(transform(sequence(0, size(m) div {CHUNK}), k -> aggregate(slice(m, k * {CHUNK} + 1, {CHUNK}), 0,
                                                                            (a, z) -> a + z.gap + z.hit))),
              sums -> flatten(transform(sequence(0, size(m) div {CHUNK}), k -> transform(
                array(named_struct('part', slice(m, k * {CHUNK} + 1, {CHUNK}), 'from', aggregate(slice(sums, 1, k), 0, (a, z) -> a + z))),
                c -> transform(c.part, (z, i) -> transform(
                  array(c.from + z.gap + aggregate(slice(c.part, 1, i), 0, (a, y) -> a + y.gap + y.hit)),
                  low -> named_struct('low', low, 'high', -(low + z.hit),
                                      'priority', r.priority, 'label', r.label, 'weight', r.weight))[0]))[0]))))))))"""
    # in the order of (first word, longest, priority) an interval lies within an earlier one
    # if it ends no later than the furthest end so far; high is stored negated for this order
    standing = f"""
        aggregate(array_sort({intervals}),
          named_struct('reach', 0, 'labels', CAST(array() AS array<string>), 'weight', 0.0D),
          (a, s) -> IF(-s.high <= a.reach, a, named_struct(
            'reach', -s.high, 'labels', array_union(a.labels, array(s.label)), 'weight', greatest(a.weight, s.weight))))"""
    return F.expr(standing)


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, rules: list[Rule] | None = None) -> DataFrame:
    """``docs`` with a column ``scan``: ``n_words``, the phrases' ``n_base, first_word,
    last_word, base_labels``, all ``labels`` (sorted) and ``score``."""
    phrases, rules = phrases or BASE_PHRASES, RULES if rules is None else rules
    line = F.col(LINE)
    lines = docs.withColumn(LINE, normal_line(F.col("text")))
    anchored = reduce(lambda a, b: a | b, [F.contains(line, F.lit(a)) for a in ANCHORS])
    parts = {f"__ls_p{i}": phrase_places(line, p) for i, p in enumerate(phrases)}
    found = lines.withColumns(parts | {"__ls_rules": F.when(anchored, rules_array(rules))})
    found = found.withColumn("__ls_found", F.when(F.col("__ls_rules").isNotNull(), detections(rules)))
    places = [F.col(p) for p in parts]
    base = F.array_sort(
        F.array_distinct(
            F.filter(F.array(*[F.when(p.isNotNull(), F.lit(x)) for p, x in zip(places, phrases.values())]), lambda x: x.isNotNull())
        )
    )
    zero = F.lit(0).cast("long")
    least, most = (F.least, F.greatest) if len(places) > 1 else (lambda x: x, lambda x: x)
    any_base = reduce(lambda a, b: a | b, [p.isNotNull() for p in places])
    result = F.struct(
        (blanks(line) - 1).cast("long").alias("n_words"),
        reduce(lambda a, b: a + b, [F.coalesce(p["n"], zero) for p in places]).alias("n_base"),
        least(*[p["first"] for p in places]).alias("first_word"),
        most(*[p["last"] for p in places]).alias("last_word"),
        base.alias("base_labels"),
        F.array_sort(F.array_union(base, F.coalesce(F.col("__ls_found.labels"), F.array().cast("array<string>")))).alias("labels"),
        F.greatest(F.coalesce("__ls_found.weight", F.lit(0.0)), F.when(any_base, F.lit(0.5)).otherwise(0.0)).alias("score"),
    )
    return found.select(*[F.col(f"`{c}`") for c in docs.columns if c != "scan"], result.alias("scan"))
