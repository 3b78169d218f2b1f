"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key scaled by its quality, ``-ln(u) / quality``, with u
in (0, 1) from a digest of the document; within a source the documents stand in the order of
their keys.  A source's target is first met by complete epochs, each of which takes every
document once; what is left of it (less than the source's size) is the budget of the
fractional epoch, which takes documents in key order up to the budget.  The document that
the budget ends in is taken if that comes nearer to the target.

No source is sorted by one task.  The words of a source are added up in 4,096 ranges of the
key's logarithm and prefix-summed; the range in which the budget ends is cut again until it
holds at most ``most_rows`` documents, and only these are sorted and prefix-summed one by one.
Documents that share a key (repeated rows) are cut in the same way by a hash of the row.

Only DataFrame functions run on the executors.

Defined results: a null or blank text has size 0 and takes nothing; a null source is a source
of its own, last in order; a source without words has target 0; quality that is null or not
positive counts as the least positive one; repeated rows share a key and follow each other,
and each is a document of its own; an empty table gives an empty result.  Only the columns
in ``keep``, ``doc_id``, ``text``, ``source`` and those named in ``quality`` are read, whatever the
others are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import sequential_key
from .common import freeze, join_spread

KEEP, SOURCE, ROW, SIZE, AT, TIE = "__mx_keep", "__mx_source", "__mx_row", "__mx_size", "__mx_at", "__mx_tie"
STEPS = 2.0**45  # places of a key's logarithm in one unit
CELLS = 4096  # ranges that one round cuts a range into
TIES = 1 << 62

# fixed values of the default quality: characters that prose is poor in, and mean word lengths of prose
MARKS = "0123456789#$%&*+/<=>@[\\]^_`{|}~"
LEAST, SHORTEST, LONGEST = 0.1, 3, 12


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def prose_quality(text: Column, size: Column) -> Column:
    """From 0.1 to 1: the share of characters that are no digits or marks, halved where the
    mean word is shorter or longer than words of prose."""
    chars = F.length(text)
    prose = F.length(F.translate(text, MARKS, "")) / chars
    usual = F.when(chars.between(size * SHORTEST, size * LONGEST), 1.0).otherwise(0.5)
    return F.when((chars > 0) & (size > 0), LEAST + (1 - LEAST) * prose * usual).otherwise(LEAST)


def keyed(docs: DataFrame, keep: tuple[str, ...], quality: Column | None, seed: int) -> DataFrame:
    """The columns ``keep`` as a struct, the source's name (null last in order), the size, the place of
    the key on a logarithmic scale, and a number for each row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("t"))
    rows = docs.select(
        F.struct(*keep).alias(KEEP), name.alias(SOURCE), word_count(text).alias(SIZE), text.alias("__mx_text"),
        F.lit(None).alias("__mx_quality") if quality is None else quality.cast("double").alias("__mx_quality"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__mx_id"),
    )
    text = F.col("__mx_text")
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), "__mx_id", F.md5(text.cast("binary"))).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / 2.0**52
    weight = prose_quality(text, F.col(SIZE)) if quality is None else F.col("__mx_quality")
    weight = F.when(weight > 1e-300, F.least(weight, F.lit(1e300))).otherwise(1e-300)
    place = F.floor((F.ln(-F.ln(u)) - F.ln(weight)) * STEPS).cast("long")
    rows = rows.select(KEEP, SOURCE, SIZE, place.alias(AT), F.monotonically_increasing_id().alias(ROW))
    return rows.withColumn(TIE, F.shiftrightunsigned(F.xxhash64(ROW), 2))


def targets(rows: DataFrame, weights: tuple[int, ...], most_epochs: int) -> DataFrame:
    """One row a source: ``n``, ``source_size``, ``target``, ``epochs`` and the ``budget``
    of the fractional epoch.  Weights repeat over the sources in order; what a source cannot
    take within ``most_epochs`` is shared anew by weight among the others."""
    sources = rows.groupBy(SOURCE).agg(
        F.count(F.lit(1)).alias("n"), F.sum(SIZE).alias("source_size"), F.min(AT).alias("least"), F.max(AT).alias("most")
    )
    ranked = sequential_key(freeze(sources, "mixing-sources"), [SOURCE], "__mx_rank", tiebreak=[])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("__mx_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = freeze(ranked.withColumn("weight", weight), "mixing-ranked")
    cap = F.col("source_size") * most_epochs
    both = ranked.agg(F.sum("source_size").alias("a"), F.sum("weight").alias("w")).first()
    words, heft = both["a"] or 0, both["w"] or 0
    free, of = words, heft
    while True:  # the share for each weight only grows, so a source at its cap stays there
        full = ranked.filter(cap * F.lit(float(of)) <= F.col("weight") * F.lit(float(free)))
        taken = full.agg(F.sum(cap).alias("a"), F.sum("weight").alias("w")).first()
        now = words - (taken["a"] or 0), heft - (taken["w"] or 0)
        if now == (free, of) or not now[1]:
            break
        free, of = now
    share = F.col("weight") * F.lit(float(free)) / F.lit(float(of or 1))
    target = F.when(cap * F.lit(float(of)) <= F.col("weight") * F.lit(float(free)), cap.cast("double")).otherwise(share)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    out = ranked.withColumn("target", target).withColumn("epochs", epochs)
    return freeze(out.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")), "mixing-targets")


def narrow(rows: DataFrame, cuts: DataFrame, column: str, most_rows: int) -> DataFrame:
    """``cuts`` (one row a source: ``n`` rows to look at, of them ``inside`` from ``lo`` to ``hi`` of
    ``column``, words ``before`` these, and the ``budget``) with the range in which the budget ends cut
    down until ``most_rows`` are inside or one value is left."""
    while True:
        cell = F.expr(f"({column} - lo) div ((hi - lo) div {CELLS} + 1)")
        placed = join_spread(rows, cuts, SOURCE, [ROW]).filter(F.col(column).between(F.col("lo"), F.col("hi")))
        cells = placed.groupBy(SOURCE, cell.alias("cell")).agg(F.sum(SIZE).alias("words"), F.count(F.lit(1)).alias("rows"))
        upto = F.sum("words").over(Window.partitionBy(SOURCE).orderBy("cell"))  # at most CELLS rows a source
        ends = cells.withColumn("upto", upto).join(cuts, SOURCE).filter("before + upto > budget")
        last = ends.groupBy(SOURCE).agg(F.min(F.struct("cell", "upto", "words", "rows")).alias("c"))
        width = F.expr(f"(hi - lo) div {CELLS} + 1")
        lo = F.col("lo") + F.col("c.cell") * width
        cuts = cuts.join(last, SOURCE).select(
            SOURCE, "n", "budget", lo.alias("lo"), F.least("hi", lo + width - 1).alias("hi"),
            (F.col("before") + F.col("c.upto") - F.col("c.words")).alias("before"), F.col("c.rows").alias("inside"),
        )
        cuts = freeze(cuts, "mixing-cuts")
        if cuts.filter((F.col("lo") < F.col("hi")) & (F.col("inside") > most_rows)).isEmpty():
            return cuts


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    most_epochs: int = 3,
    quality: Column | None = None,
    keep: tuple[str, ...] = ("doc_id",),
    seed: int = 11,
    most_rows: int = 1 << 16,
) -> DataFrame:
    """One row per row of ``docs``: the columns ``keep``, ``size`` (words), ``source_size``, ``target``,
    ``copies`` (how often the mix takes the document) and ``taken`` (words it takes).  The
    sources share all words by ``weights``, none above ``most_epochs`` times its size."""
    rows = freeze(keyed(docs, keep, quality, seed), "mixing-rows")
    sources = targets(rows, weights, most_epochs)
    start = sources.filter("source_size > 0").select(
        SOURCE, "n", "budget", F.col("least").alias("lo"), F.col("most").alias("hi"),
        F.lit(0).cast("long").alias("before"), F.col("n").alias("inside"),
    )
    cuts = narrow(rows, start, AT, most_rows)
    plain = cuts.withColumns({"tie_lo": F.lit(0).cast("long"), "tie_hi": F.lit(TIES)})
    heavy = cuts.filter(F.col("inside") > most_rows)
    if not heavy.isEmpty():  # one key with many rows: these are told apart by the hash of the row
        tied = join_spread(rows, heavy.select(SOURCE, "n", "lo"), SOURCE, [ROW]).filter(F.col(AT) == F.col("lo"))
        tied = freeze(tied.select(SOURCE, ROW, SIZE, TIE), "mixing-tied")
        ties = heavy.withColumns({"n": F.col("inside"), "lo": F.lit(0).cast("long"), "hi": F.lit(TIES)})
        ties = narrow(tied, ties, TIE, most_rows).select(
            SOURCE, F.col("lo").alias("tie_lo"), F.col("hi").alias("tie_hi"), "before"
        )
        plain = plain.join(ties.select(SOURCE), SOURCE, "left_anti").unionByName(
            heavy.drop("before").join(ties, SOURCE)
        )
    facts = sources.select(SOURCE, "n", "source_size", "target", "epochs").join(plain.drop("n"), SOURCE, "left")
    placed = join_spread(rows, freeze(facts, "mixing-plan"), SOURCE, [ROW])
    first = (F.col(AT) < F.col("lo")) | ((F.col(AT) == F.col("lo")) & (F.col(TIE) < F.col("tie_lo")))
    within = F.col(AT).between(F.col("lo"), F.col("hi")) & F.col(TIE).between(F.col("tie_lo"), F.col("tie_hi"))
    within = F.coalesce(within, F.lit(False))
    # where the budget ends: at most ``most_rows`` a source, prefix-summed in key order
    order = Window.partitionBy(SOURCE).orderBy(AT, TIE, ROW).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("budget") - F.col("before") - F.coalesce(F.sum(SIZE).over(order), F.lit(0))
    ending = placed.filter(within).withColumn("extra", left * 2 >= F.col(SIZE))
    other = placed.filter(~within).withColumn("extra", F.coalesce(first, F.lit(False)))
    copies = F.when(F.col(SIZE) > 0, (F.col("epochs") + F.col("extra").cast("long")).cast("int")).otherwise(0)
    return other.unionByName(ending).select(
        f"{KEEP}.*", F.col(SIZE).alias("size"), "source_size", "target", copies.alias("copies"), (F.col(SIZE) * copies).alias("taken")
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, numbered from 1 in ``copy``."""
    return mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
