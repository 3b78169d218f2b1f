"""XXH64 as a DuckDB expression, for the oracles of the hash keys.

Plain arithmetic modulo 2^64 over the bytes of the text; nothing is shared with Spark.
"""

from __future__ import annotations

# The primes of XXH64 (fixed values)
P1, P2, P3, P4, P5 = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)


def xxh64(text: str, seed: str) -> str:
    """XXH64 of the UTF-8 bytes of a text as an unsigned UHUGEINT, in arithmetic modulo 2^64;
    ``seed`` is an unsigned UHUGEINT expression."""
    u = "::UHUGEINT"
    two64 = f"18446744073709551616{u}"

    def bind(name: str, value: str, body: str) -> str:
        return f"list_transform([{value}], lambda {name}: {body})[1]"

    def turn(x: str, bits: int) -> str:
        return f"(({x} * {2**bits}{u}) % {two64} + {x} // {2**(64 - bits)}{u})"

    def times(x: str, prime: int) -> str:
        return f"(({x}) * {prime}{u} % {two64})"

    def mixed(state: str, word: str, name: str) -> str:
        return times(bind(name, f"({state} + {times(word, P2)}) % {two64}", turn(name, 31)), P1)

    def number(at: str, size: int) -> str:
        return "(" + " + ".join(f"bs[{at} + {k + 1}] * {256**k}{u}" for k in range(size)) + ")"

    words = ", ".join(number(f"32 * st + {8 * k}", 8) for k in range(4))
    start = [f"(sd + {(P1 + P2) % 2**64}{u}) % {two64}", f"(sd + {P2}{u}) % {two64}", "sd", f"(sd + {2**64 - P1}{u}) % {two64}"]
    lanes = (
        f"list_reduce(list_transform(range(0, len(bs) // 32), lambda st: [{words}]), lambda la, lw: ["
        + ", ".join(mixed(f"la[{k}]", f"lw[{k}]", "m1") for k in range(1, 5))
        + f"], [{', '.join(start)}])"
    )
    joined = "(" + " + ".join(turn(f"v[{k}]", bits) for k, bits in zip(range(1, 5), (1, 7, 12, 18))) + f") % {two64}"
    # every later step is h = rotate(h xor a) * m + c: a list of [a, 2^rotation, m, c]
    added = [f"{P4}{u}"] * 3 + [f"({P4}{u} + len(bs){u})"]  # the length is added after the last lane
    merge = ", ".join(f"[{mixed(f'0{u}', f'v[{k}]', 'm2')}, 1{u}, {P1}{u}, {c}]" for k, c in zip(range(1, 5), added))
    done32, done8 = "len(bs) // 32 * 32", "len(bs) // 8 * 8"
    tail = (
        f"list_transform(range({done32}, {done8}, 8), lambda o8: [{mixed(f'0{u}', number('o8', 8), 'm3')}, {2**27}{u}, {P1}{u}, {P4}{u}])"
        f" || list_transform(range({done8}, len(bs) // 4 * 4, 4), lambda o4: [{times(number('o4', 4), P1)}, {2**23}{u}, {P2}{u}, {P3}{u}])"
        f" || list_transform(range(len(bs) // 4 * 4, len(bs)), lambda o1: [{times('bs[o1 + 1]', P5)}, {2**11}{u}, {P1}{u}, 0{u}])"
    )
    long = bind("v", lanes, f"[[{joined}, 0{u}, 0{u}, 0{u}], {merge}]")
    short = f"[[(sd + {P5}{u} + len(bs){u}) % {two64}, 0{u}, 0{u}, 0{u}]]"
    moved = f"((x * s[2]) % {two64} + x * s[2] // {two64})"
    step = bind("x", "xor(a[1], s[1])", f"(({moved}) * s[3] % {two64} + s[4]) % {two64}")
    hashed = f"list_reduce((CASE WHEN len(bs) >= 32 THEN {long} ELSE {short} END) || {tail}, lambda a, s: [{step}])[1]"
    ends = bind("e1", hashed, times(f"xor(e1, e1 // {2**33}{u})", P2))
    ends = bind("e2", ends, times(f"xor(e2, e2 // {2**29}{u})", P3))
    ends = bind("e3", ends, f"xor(e3, e3 // {2**32}{u})")
    octets = f"list_transform(range(0, strlen(hx), 2), lambda p: CAST('0x' || hx[p + 1:p + 2] AS INTEGER){u})"
    return bind("sd", seed, bind("hx", f"hex(encode({text}))", bind("bs", octets, ends)))


def signed64(x: str) -> str:
    """The BIGINT with the bits of an unsigned 64-bit number."""
    return f"CAST(CASE WHEN {x} >= 9223372036854775808 THEN CAST({x} AS HUGEINT) - 18446744073709551616 ELSE CAST({x} AS HUGEINT) END AS BIGINT)"


def key_joined(columns: list[str], seed: int = 42) -> str:
    """``xxhash64(concat_ws('||', columns))``, unsigned."""
    return xxh64("concat_ws('||', " + ", ".join(columns) + ")", f"{seed}::UHUGEINT")


def key_chained(columns: list[str], seed: int = 42) -> str:
    """``xxhash64(columns)``, unsigned: each column's hash is the seed of the next; a NULL
    leaves the hash as it is."""
    h = f"{seed}::UHUGEINT"
    for c in columns:
        h = f"list_transform([{h}], lambda h_{c}: CASE WHEN {c} IS NULL THEN h_{c} ELSE {xxh64(c, f'h_{c}')} END)[1]"
    return h
