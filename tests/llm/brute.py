"""Plain versions of what the operators must return, and rows that try their edges."""

from __future__ import annotations

import hashlib
import random
import re
import struct
from collections import defaultdict

import xxhash
from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# names that the operators use inside
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in ("id", "h", "kept", "masked", "mixing", "quality_rules", "component", "_m")],
    ]
)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    """Ids and texts: nulls, empty and blank texts, copies, near copies, repeats within a text, long texts, odd letters."""
    base, other = prose(1, 120), prose(2, 200)
    near = base.split()
    near[60] = "changed"
    passage = prose(3, 70)
    return [
        (1, base),
        (2, base),
        (3, " ".join(near)),
        (4, other),
        (5, f"{prose(4, 40)} {passage} {prose(5, 30)}"),
        (6, f"{prose(6, 25)}\n{passage}\t{prose(7, 45)}"),
        (7, None),
        (8, ""),
        (9, " \n\t "),
        (10, "one"),
        (11, "ONE"),
        (12, "too few words here"),
        (13, f"{passage} {passage} {passage}"),
        (14, "ab " * 900),
        (15, prose(8, 30_000)),
        (16, "ünïcödé 日本語   \x1c " * 60),
        (17, "x" * 3000),
        (18, "x" * 2500),
        (None, other),
        (None, None),
        (20, prose(9, 60)),
        (20, prose(9, 60)),
        (21, prose(10, 60)),
        (21, prose(11, 60)),
        (22, base.upper()),
    ]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    data = [
        (i, t, ["en", "de", None][k % 3], ["hot", "hot", "cold", None][k % 4], None if t is None else len(t), *["x"] * 8)
        for k, (i, t) in enumerate(rows)
    ]
    return spark.createDataFrame(data, SCHEMA)


def order(rows: list[tuple[int | None, str | None]], hashes: list[int]) -> list[int]:
    """Places of the distinct documents: by id, null first, then by text hash."""
    first: dict[tuple, int] = {}
    for k, (i, _) in enumerate(rows):
        first.setdefault((-(2**63) if i is None else i, hashes[k]), k)
    return [first[k] for k in sorted(first)]


def substring(rows: list, hashes: list[int], k: int = 20) -> dict[tuple, tuple]:
    seen: set[str] = set()
    out = {}
    for at in order(rows, hashes):
        i, text = rows[at]
        own = words(text)
        gone = [False] * len(own)
        for j in range(len(own) - k + 1):
            window = " ".join(own[j : j + k])
            if window in seen:
                gone[j : j + k] = [True] * k
            seen.add(window)
        kept = " ".join(w for w, g in zip(own, gone, strict=True) if not g)
        out[i, hashes[at]] = (len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def suffixes(rows: list, hashes: list[int], k: int = 400) -> dict[tuple, tuple]:
    found: dict[bytes, int] = {}
    places = order(rows, hashes)
    data = {at: (rows[at][1] or "").encode() for at in places}
    for own in data.values():
        for j in range(len(own) - k + 1):
            key = hashlib.md5(own[j : j + k]).digest()
            found[key] = found.get(key, 0) + 1
    out = {}
    for at, own in data.items():
        gone = bytearray(len(own))
        for j in range(len(own) - k + 1):
            if found[hashlib.md5(own[j : j + k]).digest()] > 1:
                gone[j : j + k] = b"\1" * k
        spans = sum(1 for j, g in enumerate(gone) if g and not (j and gone[j - 1]))
        kept = bytes(b for b, g in zip(own, gone, strict=True) if not g)
        out[rows[at][0], hashes[at]] = (len(own), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def near(rows: list, hashes: list[int]) -> dict[tuple, tuple]:
    """(set size, component) by document; a component is named by id, a null id being the smallest."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    places = order(rows, hashes)
    sets = []
    for at in places:
        own = words((rows[at][1] or "").translate(lower))
        sets.append({tuple(own[j : j + 5]) for j in range(len(own) - 4)} if len(own) > 4 else {tuple(own)} - {()})
    up = list(range(len(places)))
    for a in range(len(places)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((up[a], up[b]))
                up = [x if u == y else u for u in up]
    return {(rows[at][0], hashes[at]): (len(sets[k]), rows[places[up[k]]][0]) for k, at in enumerate(places)}


def repeated_words(own: list[str], k: int = 8) -> int:
    seen: dict[tuple, list[int]] = {}
    for j in range(len(own) - k + 1):
        seen.setdefault(tuple(own[j : j + k]), []).append(j)
    return len({p for places in seen.values() if len(places) > 1 for j in places for p in range(j, j + k)})


def luhn(digits: str) -> bool:
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def personal(text: str | None) -> list[tuple[str, int, int]]:
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    kinds = ["email", "ip", "card", "phone"]
    return sorted(out, key=lambda s: (s[1], kinds.index(s[0])))


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every run of spans that share code points as the name of its first one; spans in their order."""
    runs: list[list] = []
    for kind, start, end in spans:
        if runs and start < runs[-1][2]:
            runs[-1][2] = max(end, runs[-1][2])
        else:
            runs.append([kind, start, end])
    for kind, start, end in reversed(runs):
        text = f"{text[:start]}<{kind.upper()}>{text[end:]}"
    return text


def capped_fitting(cells: list[tuple], shares: list[dict | float], sweeps: int, budget: float) -> dict[tuple, float]:
    """Capped proportional fitting by bisection: probability per cell of (key, tokens).

    ``shares`` per dimension: of each value, or a power of its own tokens.
    """
    whole = budget * sum(n for _, n in cells)
    parts = []
    for d, wanted in enumerate(shares):
        has = defaultdict(float)
        for key, n in cells:
            has[key[d]] += n
        share = {v: wanted.get(v, 0.0) if isinstance(wanted, dict) else has[v] ** wanted for v in has}
        low, high = 0.0, 1e12
        for _ in range(300):
            x = (low + high) / 2
            low, high = (x, high) if sum(min(has[v], x * share[v]) for v in has) < whole else (low, x)
        parts.append({v: min(has[v], high * share[v]) for v in has})
    factor = {key: 1.0 for key, _ in cells}
    for _ in range(sweeps):
        for d in range(len(shares)):
            for v, part in parts[d].items():
                own = [(key, n) for key, n in cells if key[d] == v]
                low, high = 0.0, 1e9
                for _ in range(200):
                    t = (low + high) / 2
                    low, high = (t, high) if sum(n * min(1.0, factor[key] * t) for key, n in own) < part * (1 - 1e-13) else (low, t)
                for key, _ in own:
                    factor[key] *= high
    return {key: min(1.0, factor[key]) for key, _ in cells}


def topic(text: str, hashes: dict[str, int], planes: int, least_bytes: int) -> int:
    """The side of each plane that more of the text's long words are on."""
    long = [hashes[w] for w in words(text) if len(w.encode()) >= least_bytes]
    return sum((sum(1 if h >> bit & 1 else -1 for h in long) > 0) << bit for bit in range(planes))


def draw(doc_id: int, seed: int) -> float:
    """A number in [0, 1) by the id: the 64-bit hash of id and seed, one after the other."""
    first = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)
    return xxhash.xxh64_intdigest(struct.pack("<i", seed), first) % 2**53 / 2**53
