"""Plain versions of the operators, to compare with."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def first_id(i):
    return (i is not None, i or 0)


def op1(docs):
    def fp(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        if not w:
            return 0
        s = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [fp(t) for _, t, _ in docs]
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    distinct = sorted(parent)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    least = defaultdict(list)
    for (i, _, _), f in zip(docs, fps):
        least[root(f)] += [i] if i is not None else []
    return [(i, f"{f:016x}", min(least[root(f)], default=None)) for (i, _, _), f in zip(docs, fps)]


def op2(docs):
    """Without ``kept``, which of tied rows stays is open."""
    groups = defaultdict(list)
    for i, t, _ in docs:
        groups[lower(t)].append(i)
    return [
        (i, max(groups[lower(t)], key=first_id), len(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest())
        for i, t, _ in docs
    ]


def op4(docs, size=100):
    seen, out = set(), []
    for i, t, _ in sorted(docs, key=lambda d: first_id(d[0])):
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - size + 1):
            s = b[k : k + size]
            if s in seen:
                gone[k : k + size] = [True] * size
            seen.add(s)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def op5(docs):
    def tokens(t):
        return [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), None]

    c = Counter(w for i, t, _ in docs if fold(i, 7) != 2 for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return [
        (i, fold(i, 7) == 2, len(w := tokens(t)), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
        for i, t, _ in docs
    ]


def op5_score(docs, mix=0.7, base=1.5, order=2):
    """``score`` with exactly read quantised counts."""

    def tokens(t):
        return [*["\nbefore"] * (order - 1), *re.findall(r"[^\x20\x09-\x0D]+", lower(t)), "\nend"]

    def count(c):
        level = 1 + math.floor(math.log(c) / math.log(base) + 1e-9) if c else 0
        return max(1.0, (base ** (level - 1) + base**level - 1) / 2) if c else 0.0

    learned = [tokens(t) for i, t, _ in docs if fold(i, 7) != 2]
    grams, words = Counter(), Counter(x for w in learned for x in w[order - 1 :])
    for w in learned:
        for k in range(1, order + 1):
            grams.update(tuple(w[at - k + 1 : at + 1]) for at in range(order - 1, len(w)))
        grams.update(("\nbefore",) * k for k in range(1, order))
    n, v = sum(words.values()), len(words)

    def p(gram):
        if len(gram) == 1:
            return (count(grams[gram]) + 1) / (n + v + 1)
        seen, shorter = count(grams[gram[:-1]]), p(gram[1:])
        return mix * min(count(grams[gram]), seen) / seen + (1 - mix) * shorter if seen else shorter

    return [(i, sum(math.log10(min(1.0, p(tuple(w[at - order + 1 : at + 1])))) for at in range(order - 1, len(w)))) for i, t, _ in docs for w in [tokens(t)]]


def statistics(t):
    """The statistics that the quality rules use, of one text."""
    words, lines = [w for w in re.split(r"[ \t-\r]", t) if w], t.split("\n")
    n, n_words = max(len(t), 1), max(len(words), 1)
    share = {
        "digits": "[0-9]", "capitals": "[A-Z]", "symbols": r"[#$%&*@<>{}\[\]\\^~=+_/|]", "bars": r"\|",
        "stops": "[.,;:]", "shouts": "[!?]", "blanks": r"[ \t-\r]",
    }
    return {
        "chars": math.log1p(len(t)),
        "words": math.log1p(len(words)),
        "word_length": len(t) / n_words,
        "distinct_words": len(set(words)) / n_words,
        "distinct_lines": len(set(lines)) / len(lines),
        "repeats": sum(a == b for a, b in zip(words, words[1:])) / n_words,
        "line_length": math.log1p(n / len(lines)),
        **{name: len(re.findall(pattern, t)) / n for name, pattern in share.items()},
    }


def op7(docs, phrases, rules):
    out = []
    for i, t, _ in docs:
        w = WORD.findall(lower(t))
        places, base = [], set()
        for phrase, label in phrases.items():
            p = phrase.split()
            at = [k for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
            places += at
            base |= {label} if at else set()
        line = "".join(f" {x}" for x in w) + " "
        found = []
        for r in rules:
            for m in re.finditer(f" (?:{r.regex})(?= )", line):
                found.append((line[: m.start()].count(" "), -line[: m.end()].count(" "), r.priority, r.label, r.weight))
        standing = [x for k, x in enumerate(sorted(found)) if not any(y[1] <= x[1] for y in sorted(found)[:k])]
        labels = base | {x[3] for x in standing}
        score = max([x[4] for x in standing] + [0.5 if base else 0.0])
        out.append((i, len(w), len(places), min(places, default=None), max(places, default=None),
                    ",".join(sorted(base)), ",".join(sorted(labels)), score))
    return out


def op8(docs, benchmark, size=10):
    windows = defaultdict(set)
    for i, t in benchmark:
        w = WORD.findall(lower(t))
        for k in range(max(1, len(w) - size + 1)) if w else ():
            windows[tuple(w[k : k + size])].add("" if i is None else str(i))
    out = []
    for i, t, _ in docs:
        w, hit, items = WORD.findall(lower(t)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k : k + n])):
                    items |= found
                    hit |= set(range(k, k + n))
        sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(items), sha, bool(hit)))
    return out


def op11_targets(sizes):
    """Target of each source from its size; sources as a dict, null as None."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        free = total - sum(3 * sizes[s] for s in full)
        of = sum(weight[s] for s in names if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else weight[s] * free / of for s in names}
        over = {s for s in names if s not in full and target[s] >= 3 * sizes[s]}
        if not over or len(full | over) == len(names):
            return {s: min(t, 3.0 * sizes[s]) for s, t in target.items()}
        full |= over


def op12(vectors, parts=8, entries=16, rounds=6):
    kept = [v for v in vectors if v[1] is not None and all(c is not None and math.isfinite(c) for c in v[1])]
    whole = [[math.floor(4096 * c) for c in v[1]] for v in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, whole[i]))
    d = len(whole[0]) // parts
    cut = [[w[p * d : p * d + d] for w in whole] for p in range(parts)]
    books = [[cut[p][i] for i in order[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), e) for e, y in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for x in cut[p]:
                groups[near(x, books[p])[1]].append(x)
            books[p] = [[sum(c) // len(c) for c in zip(*groups[e])] if e in groups else y for e, y in enumerate(books[p])]
    found = [[near(cut[p][i], books[p]) for p in range(parts)] for i in range(len(kept))]
    errors, by_label = [sum(dist for dist, _ in f) for f in found], Counter()
    for v, e in zip(kept, errors):
        by_label[v[2]] += e
    sha = hashlib.sha256(",".join(str(c) for b in books for y in b for c in y).encode()).hexdigest()
    return [(v[0], "".join(f"{e:02x}" for _, e in f), e, by_label[v[2]], sha) for v, f, e in zip(kept, found, errors)]
