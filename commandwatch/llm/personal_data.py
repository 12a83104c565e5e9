"""Operator 10: personal data, by fixed patterns and a semi-Markov conditional random field.

The fixed patterns give the base spans (email, ip, card, phone). A semi-Markov conditional
random field finds further spans that are written in another way (a phone number without
its plus, an address with "at" and "dot" spelled out). Its candidates are whole spans inside
a region: a run of digit groups and their separators, or the surroundings of an at-sign.
Features look at a whole span (numbers of groups and digits, separators, checksums, its
neighbours), and dynamic programming over the groups, with entities of at most
`MOST_GROUPS` groups, chooses boundaries and kinds jointly. Text outside regions can't hold
an entity: every kind needs the digits or the at-sign that make a region.

The field is trained on a bounded sample of documents (`ROWS`, `CHARS`), with the base spans
as labels, and on the same regions rewritten in other spellings; every whole text is searched.

Results: a null or empty text has no spans. Found spans that touch a base span are left out.
Repeated rows are searched alike; an empty table gives no rows. Offsets are code points.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spark_io import each_batch, texts

KINDS = ("email", "ip", "card", "phone")
MOST_GROUPS = 8
ROWS, CHARS, REGIONS = 4_000, 8_000_000, 3_000
Span = tuple[int, int, str]  # start, end, kind

# The base patterns. Those of email and ip start only where a leftmost search
# could, and their runs aren't given back, so that long runs cost linear time.
HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

AT = re.compile(r"@| ?[\[(]at[\])] ?| at ")
SPELLED_HOST = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.| ?[\[(]dot[\])] ?| dot )[A-Za-z0-9-]{1,63}){1,6}")
RUN = re.compile(r"(?<![A-Za-z0-9+(])[+(]{0,2}[0-9][0-9().\- /]*[0-9](?![A-Za-z0-9])")
GROUP = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def only_digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _name_before(text: str, behind: int, at: int) -> int:
    """Characters of the name that ends at a place and begins behind another one."""
    size = LOCAL.match(text[max(behind, at - 4096) : at][::-1]).end()
    # A very long name: read on to its beginning.
    return LOCAL.match(text[behind:at][::-1]).end() if size == 4096 else size


def _emails(text: str) -> Iterator[Span]:
    behind, at = 0, text.find("@")
    while at >= 0:
        found = HOST.match(text, at)
        start = at
        if found:
            start = at - _name_before(text, behind, at)
        if found and start < at:
            yield start, found.end(), "email"
            behind = found.end()
            at = text.find("@", behind)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and then kind."""
    found = list(_emails(text)) if "@" in text else []
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]  # of any length, padded with zeros
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(digits := only_digits(m[0])) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(only_digits(m[0])) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# Regions -----------------------------------------------------------------------------------


class Region:
    """A stretch of a text cut into units, and the candidate spans over whole units.

    A candidate is (first unit, unit behind the last, kind, start, end, features).
    """

    def __init__(self, n_units: int, candidates: list[tuple[int, int, str, int, int, list[str]]]):
        self.n_units = n_units
        self.ending: list[list[tuple]] = [[] for _ in range(n_units + 1)]
        for c in candidates:
            self.ending[c[1]].append(c)

    def candidates(self) -> Iterator[tuple]:
        for c in self.ending:
            yield from c


def _number_features(text: str, start: int, end: int, groups: list[str], separators: list[str]) -> list[str]:
    """Features of a span of digit groups, common to all kinds."""
    digits = "".join(groups)
    signs = "".join(sorted(set("".join(separators)))) or "none"
    before, after = text[start - 1 : start], text[end : end + 1]
    features = [
        f"digits {min(len(digits), 20)}",
        f"groups {len(groups)}",
        "shape " + "-".join(str(min(len(g), 9)) for g in groups),
        f"signs {signs}",
        f"opens {text[start] if text[start] in '+(' else 'digit'}",
        "within a number" if before in ".-/" and before or after in "-/" and after else "apart",
    ]
    if 12 <= len(digits) <= 19:
        features.append("luhn" if luhn(digits) else "no luhn")
    if len(groups) == 4 and signs == ".":
        features.append("octets" if all(len(g) <= 3 and int(g) <= 255 for g in groups) else "no octets")
    return features


def _number_regions(text: str) -> Iterator[Region]:
    for run in RUN.finditer(text):
        if run.end() - run.start() < 7:
            continue
        groups = list(GROUP.finditer(text, run.start(), run.end()))
        if sum(g.end() - g.start() for g in groups) < 7:
            continue
        found = []
        for i, first in enumerate(groups):
            start = first.start()
            floor = groups[i - 1].end() if i else run.start()
            while start > floor and text[start - 1] in "+(":
                start -= 1
            digits, parts, between = 0, [], []
            for j in range(i, min(len(groups), i + MOST_GROUPS)):
                if j > i:
                    between.append(text[groups[j - 1].end() : groups[j].start()])
                parts.append(groups[j][0])
                digits += len(parts[-1])
                if digits > 19:
                    break
                if digits < 4:
                    continue
                end = groups[j].end()
                features = _number_features(text, start, end, parts, between)
                found += [(i, j + 1, kind, start, end, features) for kind in KINDS[1:]]
        yield Region(len(groups), found)


def _address_regions(text: str) -> Iterator[Region]:
    behind = 0  # names don't overlap
    for at in AT.finditer(text):
        host = SPELLED_HOST.match(text, at.end())
        if not host:
            continue
        name = _name_before(text, behind, at.start())
        if not name:
            continue
        behind = host.end()
        start, spelled = at.start() - name, at[0].strip()
        parts = re.split(r"\.| ?[\[(]dot[\])] ?| dot ", host[0])
        last = parts[-1].lower()
        features = [
            f"at {spelled}",
            f"parts {min(len(parts), 4)}",
            f"dots {'spelled' if 'dot' in host[0] else 'plain'}",
            f"ending {last}" if last in ENDINGS else "ending other",
            "name has a digit" if re.search("[0-9]", text[start : at.start()]) else "name is a word",
            f"at {spelled}, dots {'spelled' if 'dot' in host[0] else 'plain'}",
        ]
        yield Region(1, [(0, 1, "email", start, host.end(), features)])


# Generic endings of host names.
ENDINGS = frozenset("com org net edu gov mil int info biz io de fr es uk eu".split())


def regions(text: str) -> Iterator[Region]:
    yield from _number_regions(text)
    if "@" in text or "at" in text:
        yield from _address_regions(text)


# The field ---------------------------------------------------------------------------------


def _worth(weights: dict[str, float], kind: str, features: list[str]) -> float:
    return weights.get(f"{kind}|", 0.0) + sum(weights.get(f"{kind}|{f}", 0.0) for f in features)


def best_segmentation(region: Region, weights: dict[str, float]) -> list[Span]:
    """The spans of the likeliest segmentation; a unit outside all spans counts 0."""
    best, back = [0.0], [None]
    for end in range(1, region.n_units + 1):
        top, choice = best[end - 1], None
        for c in region.ending[end]:
            if (worth := best[c[0]] + _worth(weights, c[2], c[5])) > top:
                top, choice = worth, c
        best.append(top)
        back.append(choice)
    spans, at = [], region.n_units
    while at:
        c = back[at]
        if c is None:
            at -= 1
        else:
            spans.append((c[3], c[4], c[2]))
            at = c[0]
    return spans[::-1]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def _expected(region: Region, weights: dict[str, float]) -> list[tuple[tuple, float]]:
    """The chance of each candidate under the field, by forward and backward sums."""
    n = region.n_units
    worth = [[_worth(weights, c[2], c[5]) for c in region.ending[e]] for e in range(n + 1)]
    forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
    for e in range(1, n + 1):
        forward[e] = _log_sum([forward[e - 1], *(forward[c[0]] + w for c, w in zip(region.ending[e], worth[e], strict=True))])
    ahead: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for e in range(n + 1):
        for c, w in zip(region.ending[e], worth[e], strict=True):
            ahead[c[0]].append((e, w))
    for s in range(n - 1, -1, -1):
        backward[s] = _log_sum([backward[s + 1], *(backward[e] + w for e, w in ahead[s])])
    return [
        (c, math.exp(forward[c[0]] + w + backward[e] - forward[n]))
        for e in range(n + 1)
        for c, w in zip(region.ending[e], worth[e], strict=True)
    ]


def trained(examples: list[tuple[Region, set[Span]]], epochs: int = 12, rate: float = 0.5, penalty: float = 1e-3) -> dict[str, float]:
    """Weights of the greatest conditional likelihood, by adaptive gradient steps."""
    weights: dict[str, float] = defaultdict(float)
    scale: dict[str, float] = defaultdict(lambda: 1e-6)
    for kind in KINDS:
        weights[f"{kind}|"] = -2.0  # an unknown span is none
    for _ in range(epochs):
        for region, spans in examples:
            for c, chance in _expected(region, weights):
                slope = ((c[3], c[4], c[2]) in spans) - chance
                if abs(slope) < 1e-4:
                    continue
                for key in (f"{c[2]}|", *(f"{c[2]}|{f}" for f in c[5])):
                    g = slope - penalty * weights[key]
                    scale[key] += g * g
                    weights[key] += rate * g / math.sqrt(scale[key])
    return dict(weights)


def _respelled(text: str, spans: list[Span]) -> Iterator[tuple[str, set[Span]]]:
    """Every base span in other spellings, alone between two words."""
    for start, end, kind in spans:
        old = text[start:end]
        digits = only_digits(old)
        if kind == "phone" and old[2:3] in " -.":
            new = [old[3:], old[3:].replace("(", "").replace(")", "").replace(" ", "-")]
        elif kind == "card" and len(digits) == 16:
            new = [sign.join(digits[k : k + 4] for k in range(0, 16, 4)) for sign in (" ", "-", ".")]
        elif kind == "email":
            new = [old.replace("@", a).replace(".", d) for a, d in ((" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "."), (" at ", "."))]
            new += [old.replace("@", a) for a in (" (at) ", "[at]")]
        else:
            new = []
        for spelled in new:
            yield f"word {spelled} word", {(5, 5 + len(spelled), kind)}


def examples(found: list[str]) -> list[tuple[Region, set[Span]]]:
    """Regions with their spans: those of the texts, and their other spellings."""
    rows = []
    for text in found:
        base = base_spans(text)
        rows += [(region, set(base)) for region in regions(text)]
        for spelled, spans in _respelled(text, base):
            rows += [(region, spans) for region in regions(spelled)]
        if len(rows) >= REGIONS:
            break
    return rows[:REGIONS]


def fit(docs: DataFrame, rows: int = ROWS, chars: int = CHARS) -> dict[str, float]:
    """Weights from the documents with the least hashes, at most `rows` and `chars` of them."""
    order = F.xxhash64("doc_id", F.lit(13)).alias("order")
    sizes = texts(docs).where("text rlike '[0-9]'").select("doc_id", order, F.length("text").alias("size"))
    left, chosen = chars, []
    for row in sizes.orderBy("order", "doc_id", "size").limit(rows).collect():
        if row["size"] <= left and row["doc_id"] is not None:
            left -= row["size"]
            chosen.append((row["doc_id"],))
    if not chosen:
        return trained([])
    few = F.broadcast(docs.sparkSession.createDataFrame(chosen, "doc_id bigint").distinct())
    found = texts(docs).join(few, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    return trained(examples([r["text"] for r in found.orderBy(F.xxhash64("doc_id", F.lit(13)), "doc_id").collect()]))


def further_spans(text: str, base: list[Span], weights: dict[str, float]) -> list[Span]:
    """Spans of the field that touch no base span."""
    found = [span for region in regions(text) for span in best_segmentation(region, weights)]
    return [s for s in found if not any(s[0] < b[1] and b[0] < s[1] for b in base)]


def personal_data(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """doc_id, and all spans of every text as array of (kind, start, end, base)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column("text").to_pylist():
            base = base_spans(text)
            known = set(base)
            every = in_order(base + further_spans(text, base, weights))
            rows.append([{"kind": s[2], "start": s[0], "end": s[1], "base": s in known} for s in every])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "spans"])

    return each_batch(texts(docs), work, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")


def span_digests(docs: DataFrame) -> DataFrame:
    """Numbers of base spans by kind, their digest, and all spans as text."""
    found = personal_data(docs, fit(docs))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{kind}")

    counts = [number(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
