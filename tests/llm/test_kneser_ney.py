"""Toxicity models counted by Spark over all labelled texts, against the same counts in memory."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from commandwatch.llm import kneser_ney, toxicity
from commandwatch.llm.spark_io import checkpointed, prepare, without_leftovers
from commandwatch.llm.words import utf8, word_hashes


def made(rng: random.Random, toxic: bool) -> str:
    pool = [f"w{k}" for k in range(60)]
    w = [pool[min(int(rng.expovariate(0.1)), 59)] for _ in range(rng.choice([0, 1, 2, 9, 14]))]
    if toxic and w:
        w[rng.randrange(len(w))] = rng.choice(["blarg", "snork", f"x{rng.randrange(400)}"])
    return " ".join(w)


@pytest.mark.parametrize(("rows", "chars"), [(6_800, 4_000_000), (900, 2_000)])
def test_scores_follow_all_labelled_texts(spark, monkeypatch, rows, chars):
    prepare(spark)
    monkeypatch.setattr(kneser_ney, "CHARS_PER_BLOCK", chars, raising=False)
    monkeypatch.setattr(kneser_ney, "CHARS_PER_GROUP", chars, raising=False)
    monkeypatch.setattr(kneser_ney, "WORDS_AT_ONCE", 1_000, raising=False)
    rng = random.Random(rows)
    table = [(k, made(rng, k % 2 == 1)) for k in range(rows)]  # the first run: more than 3,000 of each class
    docs = spark.createDataFrame(table, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(rows)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels, F.lit(False))
    whole = toxicity._counted([[word_hashes(utf8(t)) for k, t in table if k % 2 == y] for y in (0, 1)])
    whole.weights = model.weights
    fresh = [made(rng, k % 2 == 1) for k in range(150)] + ["", None, "new", "w1 new w2", "blarg " * 30, "Blarg, w3!"]
    got = toxicity.toxicity(spark.createDataFrame(list(enumerate(fresh)), "doc_id bigint, text string"), model)
    scores = {row["doc_id"]: row["score"] for row in got.collect()}
    assert [scores[k] for k in range(len(fresh))] == pytest.approx(list(whole.scores(fresh)), abs=1e-4)


def test_repeated_rows_weigh_once(spark):
    prepare(spark)
    rng = random.Random(5)
    table = [(k, made(rng, k % 2 == 1)) for k in range(200)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)] * 2, "doc_id bigint, toxic int")
    fits = [toxicity.fit(spark.createDataFrame(rows, "doc_id bigint, text string"), labels, F.lit(False)) for rows in (table, table + table[::3])]
    assert list(fits[0].weights) == pytest.approx(list(fits[1].weights), abs=1e-6)


def test_texts_score_alike_known_or_fresh(spark, monkeypatch):
    """Texts of the fitted table have their scores from the fit; all others are measured anew."""
    prepare(spark)
    for name, value in (("CHARS_PER_BLOCK", 3_000), ("WORDS_AT_ONCE", 700)):
        monkeypatch.setattr(kneser_ney, name, value)
    rng = random.Random(11)
    rows = [(k, made(rng, k % 2 == 1)) for k in range(400)]
    rows += [*rows[:9], (None, "blarg snork"), (None, "w1 w2"), (None, None), (7, "blarg " * 12), (400, ""), (401, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels, F.col("doc_id") % 5 == 0)
    found = [sorted((str(r["doc_id"]), r["score"]) for r in toxicity.toxicity(d, model).collect()) for d in (docs, docs.select("doc_id", "text"))]
    assert len(found[0]) == len(rows) and [k for k, _ in found[0]] == [k for k, _ in found[1]]
    assert [s for _, s in found[0]] == pytest.approx([s for _, s in found[1]], abs=1e-9)
    kept = toxicity.without_toxic(docs, model).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == [k for k, s in found[0] if s < toxicity.TOXIC_FROM]


def test_memory_of_a_block_and_bytes_sent_follow_its_pairs(spark):
    rng = np.random.default_rng(3)
    names = np.unique(rng.integers(0, 1 << 63, 40_000, dtype=np.uint64) * np.uint64(2))
    codes = np.minimum(rng.zipf(1.2, 300_000), len(names)) - 1
    sink = pa.BufferOutputStream()
    rows = pa.table({"doc_id": [1, 2, 3], "key": [1, 2, 3], "label": [0, 1, None], "size": [100_000] * 3, "mask": pa.array([1, 16, 0], pa.uint8())})
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    chunk = kneser_ney.Chunk(kneser_ney._rows([(5, 1, names.tobytes(), kneser_ney._planes(codes[:, None]), sink.getvalue().to_pybytes())], kneser_ney._CHUNKS))
    assert (chunk.codes == codes).all()
    sent, pairs = chunk.sent(1, 0, 1), len(np.unique(chunk.pairs))
    tracemalloc.start()
    answers = kneser_ney._pair_block(sent)
    words = chunk.words_sent(answers, 1)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 700 * pairs  # 52 numbers of 32 bits for both words of each pair were more
    assert sum(len(x) for c in ("keys", "values") for x in sent.column(c).to_pylist()) < 16 * pairs
    assert sum(len(x) for x in answers.column("values").to_pylist()) < 3 * pairs
    assert words.num_rows == 1


def test_slices_of_blocks_leave_room_for_the_answers_of_those_before(spark):
    rng = np.random.default_rng(4)
    names = np.unique(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) * np.uint64(2))
    codes = np.minimum(rng.zipf(1.2, 200_000), len(names)) - 1
    sink = pa.BufferOutputStream()
    rows = pa.table({"doc_id": [1, 2], "key": [1, 2], "label": [0, 1], "size": [100_000] * 2, "mask": pa.array([1, 16], pa.uint8())})
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    chunk = kneser_ney.Chunk(kneser_ney._rows([(5, 1, names.tobytes(), kneser_ney._planes(codes[:, None]), sink.getvalue().to_pybytes())], kneser_ney._CHUNKS))
    for n_blocks in (1, 3, 5, 60):
        parts = min(kneser_ney.SLICES[0], n_blocks)
        slices = [chunk.sent(n_blocks, part, parts) for part in range(parts)]
        blocks = [b for sent in slices for b in sent.column("block").to_pylist()]
        assert sorted(blocks) == list(range(n_blocks))
        keys = [kneser_ney._unpacked(x) for sent in slices for x in sent.column("keys").to_pylist()]
        assert sorted(np.concatenate(keys).tolist()) == np.unique(chunk.pairs).tolist()
    moved = [sum(len(x) for c in ("keys", "values") for x in sent.column(c).to_pylist()) for sent in slices]
    answered = 0.26 * np.cumsum(moved)  # as measured on a larger table, in which pairs recur
    assert max(answered + moved) < 0.5 * sum(moved)  # three slices alike took 0.59


def test_chunks_are_written_small_and_read_whole(spark):
    prepare(spark)
    rng = random.Random(2)
    made_of = [" ".join(f"n{rng.randrange(40_000)}" for _ in range(n)) for n in (0, 1, 30_000, 20_000)] + [None, " ", "a b a c a b"]
    docs = spark.createDataFrame([(k, k, t, k % 2, k % 3) for k, t in enumerate(made_of)], "doc_id bigint, key bigint, text string, label int, fold int")
    chunks = kneser_ney.chunked(docs.coalesce(1)).toArrow()
    chunk = kneser_ney.Chunk.stored(chunks)
    words, places = kneser_ney.words_of(made_of)
    assert (chunk.names[chunk.codes] == words).all() and (chunk.places == places).all()
    assert len(chunks.column("names")[0].as_py()) < 7 * len(chunk.names)  # hashes of eight bytes each were more
    assert (np.diff(np.bincount(chunk.codes)) <= 0).all()
    empty = kneser_ney.Chunk.stored(kneser_ney.chunked(docs.where("doc_id in (0, 4, 5)").coalesce(1)).toArrow())
    assert len(empty.names) == len(empty.codes) == 0 and empty.rows.num_rows == 3


def test_jobs_remove_their_shuffle_files(spark):
    with without_leftovers(spark):
        df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        checkpointed(df)
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = tracker.shuffleStatuses().size()
    with without_leftovers(spark):
        checkpointed(df.groupBy("count").count())
    assert tracker.shuffleStatuses().size() <= before


def peak(work):
    """MB that Python held at once, beside what it held before."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_blocks_are_unpacked_range_by_range(monkeypatch):
    """Memory follows what a block is sent, packed, and not all columns of all of its rows at once."""
    rng = np.random.default_rng(3)
    width = kneser_ney._PARTS[-1] + 1
    words = []
    for chunk in range(8):
        keys = np.sort(rng.integers(0, 1 << 62, 40_000, dtype=np.uint64))
        keys[:100] = np.arange(100)  # in all chunks
        values = rng.integers(0, 2, (5, width), dtype=np.uint32)[rng.integers(0, 5, len(keys))]
        words.append((0, chunk, kneser_ney._packed(keys), kneser_ney._coded(values)))
    words = kneser_ney._rows(words, kneser_ney._SENT_ARROW)
    pairs = []
    for chunk in range(8):
        keys = np.sort(rng.integers(0, 1 << 62, 60_000, dtype=np.uint64))
        keys[:100] = np.arange(100)
        each = rng.integers(1, 3, len(keys), dtype=np.uint32)
        before = rng.integers(0, 1 << 40, int(each.sum()), dtype=np.uint64)
        parts = [kneser_ney._planes(each[:, None]), kneser_ney._planes((1 << rng.integers(0, 6, (len(before), 1))).astype(np.uint32))]
        sizes = np.array([len(x) for x in parts], np.int64)
        pairs.append((0, chunk, kneser_ney._packed(keys), sizes.tobytes() + b"".join(parts) + before.view(np.uint8).reshape(-1, 8)[:, :5].tobytes()))
    pairs = kneser_ney._rows(pairs, kneser_ney._SENT_ARROW)
    whole = {}
    for at_once in (1 << 14, 1 << 30):  # ranges, and all at once: the same answers
        monkeypatch.setattr(kneser_ney, "KEYS_AT_ONCE", at_once, raising=False)
        for work, table, most in ((kneser_ney._word_sums, words, 45), (kneser_ney._word_totals, words, 45), (kneser_ney._pair_block, pairs, 45)):
            if at_once < 1 << 30:
                assert peak(lambda work=work, table=table: work(table)) < most
                whole[work] = work(table)
            else:
                assert work(table).equals(whole[work])


def test_texts_are_weighed_in_groups_of_rows(monkeypatch):
    rng = np.random.default_rng(4)
    names = np.sort(rng.integers(0, 1 << 62, 3_000, dtype=np.uint64))
    sizes = [0, 900, 1, 2, 40, 0, 700, 300, 5, 0]
    codes = np.minimum(rng.zipf(1.3, sum(sizes)), len(names)) - 1
    masks = [0, 1, 8, 2, 16, 4, 32, 0, 1, 8]
    sink = pa.BufferOutputStream()
    rows = pa.table({"doc_id": range(10), "key": range(10), "label": [0] * 10, "size": sizes, "mask": pa.array(masks, pa.uint8())})
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    table = kneser_ney._rows([(5, 1, names.tobytes(), kneser_ney._planes(codes[:, None]), sink.getvalue().to_pybytes())], kneser_ney._CHUNKS)
    chunk = kneser_ney.Chunk(table)
    n_pairs = len(np.unique(chunk.pairs))
    answers = [(kneser_ney.PAIRS, 5, 0, rng.integers(0, 3, (n_pairs, 2 * kneser_ney.MODELS + 1))), (kneser_ney.WORDS, 5, 0, rng.integers(0, 9, (len(names), kneser_ney._PARTS[-1])))]
    answers = kneser_ney._rows([(*kind, kneser_ney._coded(values.astype(np.uint32))) for *kind, values in answers], kneser_ney._ANSWERS_ARROW)
    weighing = [kneser_ney._weighing(rng.integers(10, 20, (6, 3 * kneser_ney.MODELS)), rng.integers(900, 999, (6, 2 * kneser_ney.MODELS)), 3_000, m) for m in range(kneser_ney.MODELS)]

    def found(at_once: int) -> np.ndarray:
        monkeypatch.setattr(kneser_ney, "PAIRS_AT_ONCE", at_once)
        values, groups = np.zeros((kneser_ney.MODELS, len(sizes), 4)), 0
        for m, rows, ratios, places in kneser_ney.Chunk(table).ratios(answers, weighing):
            values[m, rows], groups = toxicity.evidence(ratios, places, len(rows)), groups + 1
        return values, groups

    (whole, one_each), (values, groups) = found(1 << 16), found(100)
    assert one_each == kneser_ney.MODELS and groups > 2 * one_each
    assert whole[-1].any() and (values == whole).all()
    assert not whole[:-1, [k for k, mask in enumerate(masks) if not mask]].any()


def test_tokenizers_of_earlier_stages_are_let_go():
    from commandwatch.llm import bpe, spark_io

    bpe._ENCODERS["some"] = None
    assert spark_io.freed(lambda table: table)(pa.table({"a": [1]})).num_rows == 1
    assert not bpe._ENCODERS
