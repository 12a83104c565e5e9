"""Models against plain re-computations, and the pipeline against its stages in plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import xxhash
import zstandard
from tokenizers import Tokenizer

import corpus_pipeline
from commandwatch.llm import fingerprints, personal_data, quality_classifier, quality_rules, secrets, toxicity
from commandwatch.llm.near_dedup import Likeness
from commandwatch.llm.spark_io import prepare
from commandwatch.llm.words import word_hashes

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
BLANKS = " \t\n\r\x0b\x0c"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return regex.findall(r"[^\x20\x09-\x0D]+", text or "")


# Toxicity: Kneser-Ney with dictionaries ----------------------------------------------------


def discounts(counts: list[int]) -> list[float]:
    n = Counter(counts)
    if not all(n[k] for k in (1, 2, 3, 4)):
        return [0.0, 0.75, 0.75, 0.75]
    y = n[1] / (n[1] + 2 * n[2])
    return [0.0, *(min(max(k - (k + 1) * y * n[k + 1] / n[k], 0), k) for k in (1, 2, 3))]


class PlainKneserNey:
    """Log ratios of every word and pair, from texts (lists of words) of the two classes."""

    def __init__(self, by_class: list[list[list[str]]]):
        self.vocabulary = {w for part in by_class for t in part for w in t}
        n = max(len(self.vocabulary), 1)
        self.pairs: list[Counter] = []
        for part in by_class:
            triples = {(t[i - 1], t[i], t[i + 1]) for t in part for i in range(1, len(t) - 1)}
            self.pairs.append(Counter((b, c) for _, b, c in triples))
        self.continuation = [Counter(c for _, c in pairs) for pairs in self.pairs]
        self.off_words = [discounts(list(c.values())) for c in self.continuation]
        self.off_pairs = [discounts(list(p.values())) for p in self.pairs]
        self.both = self.pairs[0] + self.pairs[1]
        self.off_both = discounts(list(self.both.values()))
        shared = {w: 1 / n + sum(off[min(c[w], 3)] for c, off in zip(self.continuation, self.off_words, strict=True)) for w in self.vocabulary}
        total = max(sum(shared.values()), 1.0)
        self.shared = {w: x / total for w, x in shared.items()}
        self.context = [Counter() for _ in range(3)]
        self.kept = [Counter() for _ in range(3)]
        for k, (pairs, off) in enumerate(zip([*self.pairs, self.both], [*self.off_pairs, self.off_both], strict=True)):
            for (b, _), count in pairs.items():
                self.context[k][b] += count
                self.kept[k][b] += count - off[min(count, 3)]

    def leave(self, k: int, word: str) -> float:
        return 1 - self.kept[k][word] / max(self.context[k][word], 1)

    def alone(self, k: int, word: str | None) -> float:
        counts, off = self.continuation[k], self.off_words[k]
        total = max(sum(counts.values()), 1.0)
        rest = 1 - sum(c - off[min(c, 3)] for c in counts.values()) / total
        if word not in self.vocabulary:
            return max(rest, 1e-9)
        return (counts[word] - off[min(counts[word], 3)]) / total + rest * self.shared[word]

    def after(self, k: int, before: str, word: str) -> float:
        pair = (before, word)
        if pair not in self.both:
            return (self.leave(k, before) if before in self.vocabulary else 1.0) * self.alone(k, word)
        own, count = self.pairs[k][pair], self.both[pair]
        both = (count - self.off_both[min(count, 3)]) / self.context[2][before] + self.leave(2, before) * self.alone(k, word)
        return (own - self.off_pairs[k][min(own, 3)]) / max(self.context[k][before], 1) + self.leave(k, before) * both

    def mean(self, text: list[str]) -> float:
        if not text:
            return 0.0
        total = math.log(self.alone(1, text[0])) - math.log(self.alone(0, text[0]))
        for before, word in zip(text, text[1:], strict=False):
            total += math.log(self.after(1, before, word)) - math.log(self.after(0, before, word))
        return total / len(text)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_kneser_ney_equals_dictionaries(seed):
    rng = random.Random(seed)
    pool = [f"w{k}" for k in range(40)]
    text = lambda: [pool[min(int(rng.expovariate(0.12)), 39)] for _ in range(rng.choice([0, 1, 2, 3, 12, 25]))]
    by_class = [[text() for _ in range(25 * seed)] for _ in range(2)]
    plain = PlainKneserNey(by_class)
    model = toxicity._counted([[word_hashes(" ".join(t).encode()) for t in part] for part in by_class])
    for fresh in [text() for _ in range(60)] + [["unknown"], ["w1", "unknown", "w2"], ["w0"] * 30]:
        ours = model.evidence(word_hashes(" ".join(fresh).encode()))[0]
        assert ours == pytest.approx(plain.mean(fresh), abs=1e-4), fresh


# Quality: sizes by zstandard alone ---------------------------------------------------------


def test_differences_equal_plain_compression():
    rng = random.Random(6)
    good = [" ".join(rng.choice(["river", "stone", "runs", "under", "bright", "cloud"]) for _ in range(80)).encode() for _ in range(120)]
    bad = [("".join(rng.choice("ABC*#$ ") for _ in range(400))).encode() for _ in range(120)]
    dictionaries = [quality_classifier.dictionary(part) for part in (bad, good)]
    sizes = quality_classifier.Compressors(dictionaries)
    for text in [*good[:20], *bad[:20], b"x", b"", b"\xc3\xa9" * 5_000, good[0] * 400]:
        plain = []
        for data in dictionaries:
            own = zstandard.ZstdCompressionDict(data)
            made = zstandard.ZstdCompressor(level=quality_classifier.LEVEL, dict_data=own, write_dict_id=False, write_content_size=False).compress(text)
            plain.append(len(made))
            assert zstandard.ZstdDecompressor(dict_data=own).decompress(made, max_output_size=len(text) + 1) == text
        expected = (plain[0] - plain[1]) / sum(plain) if text else 0.0
        assert sizes.difference(text) == expected
        if len(text) > 300 and text in (*good, *bad):
            assert (expected > 0) == (text in good)


# Secrets: candidates by another engine, features and votes in plain Python -----------------


def share(count: float, of: float) -> float:
    return count / max(of, 1)


def features(before: str, value: str, after: str, dictionary: set[str]) -> dict[str, float]:
    low, has = value.lower(), lambda pattern, text: float(bool(regex.search(pattern, text)))
    inside = regex.findall(secrets.WORD, low)
    kinds = regex.sub("[0-9]+|[a-z]+|[A-Z]+|[^0-9A-Za-z]+", "x", value)
    turns = regex.sub("[aeiou]+|[bcdfghjklmnpqrstvwxyz]+|[^a-z]+", "x", low)
    place = before[-12:] + value
    return {
        "length": len(value),
        "kind_changes": share(len(kinds), len(value)),
        "vowel_changes": share(len(turns), len(value)),
        "digit_share": share(len(regex.sub("[^0-9]", "", value)), len(value)),
        "letter_share": share(len(regex.sub("[^A-Za-z]", "", value)), len(value)),
        "distinct_share": share(len(set(value)), min(len(value), 40)),
        "dictionary_share": share(sum(len(w) for w in inside if w in dictionary), len(value)),
        "hexadecimal": has("^(?:[0-9a-f]+|[0-9A-F]+)$", value),
        "known_prefix": has("^(?:AKIA|ASIA|gh[pousr]_|xox[abprs]-|sk_live_|glpat-|eyJ|-----BEGIN)", value),
        "placeholder": has("(?i)example|your|here|change|dummy|xxxx|0000|1234", value),
        "path": has(r"(?i)(?:https?:|www\.|[a-z0-9_-]{2,}/[a-z0-9_-]{2,}/|^/|\s/)", place),
        "file": has(r"^\.[a-z]{2,4}(?:[^a-z]|$)", after),
        "address": has("^@", after),
        "assigned": has(r"[=:]\s*[\"']?$", before),
        "quoted": has(r"[\"']$", before) * has(r"^[\"']", after),
        "secret_word": has(rf"(?i)(?:{secrets.NAMES})[^A-Za-z0-9]{{0,8}}$", before),
        "checksum_word": has(r"(?i)(?:sha-?\d*|md5|commit|checksum|digest|etag|hash|uuid|revision|integrity|id|version)[^A-Za-z0-9]{0,8}$", before),
        "words_beside": sum(w in dictionary and w != "" for w in regex.split(r"[^\p{L}]+", f"{before} {after}".lower())),
    }


def votes(forest: secrets.Forest, found: dict[str, float]) -> float:
    def vote(node: tuple) -> float:
        while len(node) > 1:
            name, threshold, low, high = node
            node = low if found[secrets.FEATURES[name]] <= threshold else high
        return node[0]

    return sum(vote(t) for t in forest.trees) / len(forest.trees) if forest.trees else 0.0


def judged(text: str, forest: secrets.Forest) -> list[tuple[int, str, float]]:
    """Place, value and score of every candidate."""
    found, dictionary = list(regex.finditer(secrets.CANDIDATE, text)), set(forest.dictionary)
    ends = [0, *(m.end() for m in found)]
    starts = [*(m.start() for m in found), len(text)]
    rows = []
    for k, m in enumerate(found):
        before, after = text[ends[k] : starts[k]][-secrets.AROUND :], text[ends[k + 1] : starts[k + 1]][: secrets.AROUND]
        rows.append((m.start(), m[0], votes(forest, features(before, m[0], after, dictionary))))
    return rows


def settings(rng: random.Random, n: int) -> list[str]:
    names = ["token", "API_KEY", "password", "revision", "name", "sha256", "id", "Bearer", "x"]
    prose = "the of and river stone cloud maple runs slowly under bright old".split()
    found = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(1, 6)):
            hexed = hashlib.sha256(str(rng.random()).encode()).hexdigest()[: rng.choice([8, 20, 40, 64])]
            value = rng.choice([hexed, hexed.upper(), "your_token_here1", f"sk_live_{hexed}", "/".join(rng.sample(prose, 3)) + "/v2.py", f"{hexed}.{hexed}", "-".join(rng.sample(prose, 4)) + "7"])
            parts.append(rng.choice(prose))
            parts.append(rng.choice([f'{rng.choice(names)} = "{value}"', f"{rng.choice(names)}={value}", f"{rng.choice(names)}: {value}", f"https://example.com/{value}?a=b&token={hexed}&c=1", value, f"commit {value}.txt", f"{value}@mail"]))
        found.append(rng.choice([" ", "\n"]).join([*parts, *rng.sample(prose, 4)]))
    return found


def test_secrets_equal_another_engine(spark):
    prepare(spark)
    given = settings(random.Random(31), 400)
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(given)], SCHEMA)
    forest = secrets.fit(docs, rows=80)
    assert len(forest.trees) == secrets.TREES
    got = defaultdict(list)
    for r in secrets.findings(docs, forest).orderBy("doc_id", "number").collect():
        got[r["doc_id"]].append((r["start"], r["length"], r["value_sha256"], round(r["score"], 9)))
    expected = {k: [(at, len(v), hashlib.sha256(v.encode()).hexdigest(), round(s, 9)) for at, v, s in judged(t, forest)] for k, t in enumerate(given)}
    assert got == {k: v for k, v in expected.items() if v}
    scores = [x[3] for rows in got.values() for x in rows]
    assert len(scores) > 1_000 and 0.1 < np.mean(np.array(scores) >= secrets.SECRET_FROM) < 0.9


# Fingerprints: winnowing in plain Python ---------------------------------------------------


def winnowed(text: str) -> list[tuple[int, int]]:
    """Chosen (hash, place) of a text, in its order."""
    plain = regex.sub(r"[ \t\n\x0b\f\r]+", " ", text).strip(" ")
    found = []
    for j, sign in enumerate(plain):
        left = len(plain[j:].split(" ", 1)[0])
        if sign == " " or not (left >= 4 or j == 0 or plain[j - 1] == " "):
            continue
        run = regex.match(r"[^ ]{1,4}+ ?+[^ ]{1,4}+ ?+[^ ]{1,4}+", plain[j:])
        if run:
            found.append(xxhash.xxh64(run[0].encode(), seed=42).intdigest() >> 32)
    if not found and plain:
        found = [xxhash.xxh64(plain.encode(), seed=42).intdigest() >> 32]
    chosen: list[tuple[int, int]] = []
    for i in range(max(len(found) - 4, min(len(found), 1))):
        window = found[i : i + 5]
        place = max(i + k for k, h in enumerate(window) if h == min(window))
        if (found[place], place) not in chosen:
            chosen.append((found[place], place))
    return chosen


def test_fingerprints_equal_plain_winnowing(spark, small):
    rng = random.Random(14)
    pool = ["a", "be", "river", "stones", "under-bright", "知識", "éé", " ", "\n\t", "\x85", "ab ab ab ab ab ab", "x" * 30]
    texts = ["", None, " \n", "abc", "aa " * 40, "y" * 50, "one two"]
    texts += ["".join(rng.choice(pool) + rng.choice([" ", " ", ""]) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    texts += [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").limit(25).collect()]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(docs).collect()}
    likeness = lambda x, y: 1.0 if not x | y else len(x & y) / len(x | y)
    hashes = lambda t: {h for h, _ in winnowed(t)}
    for k, text in enumerate(texts):
        text, after = text or "", texts[(k + 1) % len(texts)] or ""
        cut = len(text) // 2
        edited = text[: len(text) - cut] + after[:cut]
        for column, one in (("fingerprint", text), ("edited_fingerprint", edited)):
            assert got[k][column] == " ".join(f"{h:x}:{place}" for h, place in winnowed(one)), one
        assert got[k]["near_edited"] == pytest.approx(likeness(hashes(text), hashes(edited)))
        assert got[k]["near_next"] == pytest.approx(likeness(hashes(text), hashes(after)))


# Quality rules and personal data on a given table ------------------------------------------


def test_kept_equals_the_rules_one_by_one(spark, small):
    folder = small.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rules = quality_rules.fit(docs, labels)
    assert rules
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    kept = 0
    for r in quality_rules.quality_verdicts(docs, labels).collect():
        w = words(texts[r["doc_id"]])
        lines = [x for x in texts[r["doc_id"]].split("\n") if words(x)]
        windows = Counter(zip(w, w[1:], w[2:], strict=False))
        twice = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
        counts = {
            "n_words": len(w),
            "word_chars": sum(map(len, w)),
            "n_symbols": len(regex.findall("[#*$%&|<>]", texts[r["doc_id"]])),
            "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": len(twice),
            "n_upper": len(regex.findall("[A-Z]", texts[r["doc_id"]])),
            "n_stops": len(regex.findall("[.!?]", texts[r["doc_id"]])),
            "n_lines": len(lines),
        }
        failed = len(w) < 50 or 100 * len(twice) > 50 * len(w)
        first = None
        for number, rule in enumerate(rules):
            values = [counts[quality_rules.RATIOS[c.ratio][0]] / max(counts[quality_rules.RATIOS[c.ratio][1]], 1) for c in rule]
            if all(x >= c.threshold if c.at_least else x <= c.threshold for x, c in zip(values, rule, strict=True)):
                first = number
                break
        assert (r["base_failed"], r["kept"], r["rule"]) == (failed, not failed and first is None, None if failed else first)
        kept += r["kept"]
    assert 0 < kept < len(texts)


def segmentations(region: personal_data.Region, start: int = 0):
    if start == region.n_units:
        yield []
        return
    for rest in segmentations(region, start + 1):
        yield rest
    for c in region.candidates():
        if c[0] == start:
            for rest in segmentations(region, c[1]):
                yield [c, *rest]


def test_the_field_chooses_the_best_of_all_segmentations():
    rng = random.Random(17)
    for _ in range(150):
        text = rng.choice(["+", "("]) + rng.choice([" ", "-", ".", ") "]).join(str(rng.randint(1, 9_999)) for _ in range(rng.randint(1, 5)))
        for region in personal_data.regions(f"w {text} w"):
            weights = defaultdict(float)
            for c in region.candidates():
                for f in ["", *c[5]]:
                    weights.setdefault(f"{c[2]}|{f}", rng.uniform(-1, 0.6))
            worth = lambda cs: sum(personal_data._worth(weights, c[2], c[5]) for c in cs)  # noqa: E731, B023
            best = max(segmentations(region), key=worth)
            chosen = personal_data.best_segmentation(region, weights)
            by_span = {(c[3], c[4], c[2]): c for c in region.candidates()}
            assert worth([by_span[s] for s in chosen]) == pytest.approx(worth(best))
            for (_, end, _), (start, _, _) in zip(chosen, chosen[1:], strict=False):
                assert end <= start


def test_added_spans_on_a_given_table(spark, small):
    prepare(spark)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    spelled = [(10_000 + k, f"call ({200 + k}) 555-{1000 + k} or ann.{k} at mail.example.com", "en", "s", 0) for k in range(40)]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(spelled, SCHEMA).select("doc_id", "text"))
    rng = random.Random(8)
    plain = [f"the +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} of re.{k}@mail{k % 9}.example.com in {rng.randint(1900, 2030)}-0{k % 9 + 1}-1{k % 9} x" for k in range(200)]
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for weights, least in ((personal_data.trained(personal_data.examples(plain)), 40), (personal_data.fit(docs), 0)):
        added = 0
        for r in personal_data.personal_data(docs, weights).collect():
            base = personal_data.base_spans(texts[r["doc_id"]])
            more = []
            for region in personal_data.regions(texts[r["doc_id"]]):
                for s in personal_data.best_segmentation(region, weights):
                    if all(s[1] <= b[0] or b[1] <= s[0] for b in base):
                        more.append(s)
            expected = [(kind, start, end, (start, end, kind) in base) for start, end, kind in personal_data.in_order(base + more)]
            assert [tuple(x) for x in r["spans"]] == expected
            added += len(more)
        assert added >= least


# The pipeline ------------------------------------------------------------------------------


def linked(rows: list[tuple], like: Likeness) -> dict[int, int]:
    sets = {}
    for d, t in rows:
        w = words(t.translate(LOW))
        sets[d] = {tuple(w[i : i + like.words]) for i in range(max(1, len(w) - like.words + 1))} if w else set()
    of = {d: d for d in sets}

    def root(x: int) -> int:
        while of[x] != x:
            x = of[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= like.percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                of[y] = x
    return {d: root(d) for d in sets}


def without_repeats(rows: list[tuple]) -> list[tuple]:
    first: dict[tuple, int] = {}
    for d, t in sorted(rows):
        w = words(t)
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i : i + 13]), d)
    kept = []
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - 12):
            if first[tuple(w[i : i + 13])] < d:
                gone[i : i + 13] = [True] * 13
        kept.append((d, " ".join(x for x, g in zip(w, gone, strict=True) if not g) if any(gone) else t))
    return kept


def test_the_pipeline_equals_its_stages_in_plain_python(spark, small, tmp_path):
    prepare(spark)
    table = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    extra = [(9_000 + k, t, "en", "s", len(t)) for k, t in enumerate(settings(random.Random(3), 30))]
    docs = table.select("doc_id", "text", "lang", "source", table["n_chars"].cast("bigint").alias("n_chars")).unionByName(spark.createDataFrame(extra, SCHEMA))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")

    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    sample = toxicity.labelled_sample(docs, labels, "toxic", toxicity.F.lit(False)).orderBy("order_", "doc_id")
    model = toxicity.fitted([(r["label"], r["text"]) for r in sample.collect()])
    rows = [row for row, s in zip(rows, model.scores([t for _, t in rows]), strict=True) if s < toxicity.TOXIC_FROM]
    component = linked(rows, Likeness())
    rows = without_repeats([(d, t) for d, t in rows if component[d] == d])
    forest = secrets.fit(spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], SCHEMA))
    expected, masked, library = Counter(), 0, Tokenizer.from_file(PATH)
    for d, text in rows:
        for at, value, score in reversed(judged(text, forest)):
            if score >= secrets.SECRET_FROM:
                text, masked = text[:at] + secrets.MARK + text[at + len(value) :], masked + 1
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            expected[d, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(map(tuple, got.collect())) == expected
    assert masked > 20 and len(rows) < docs.count()
