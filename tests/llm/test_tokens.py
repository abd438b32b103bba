"""BPE, prefix counts, packing and token files against the tokenizers library."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import bpe, packing, token_counts, token_file, vocab
from tests.llm.conftest import BYTE_BPE, ROWS, WORD_BPE

ALPHABET = [*"abst'’re vlm d  \n\t0१½Ⅷéß中　\x1c\x85!?_-İΣ\U0001f600́", "'s", "'ll", " '", "<|endoftext|>", "the"]


def noise(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def by_library(path, texts):
    return [e.ids for e in vocab.tokenizer(path).encode_batch(texts, add_special_tokens=False)]


def lists(ids, before):
    return [ids[a:b].tolist() for a, b in zip(before, before[1:])]


@pytest.mark.parametrize("path, encode", [(BYTE_BPE, vocab.byte_encode), (WORD_BPE, bpe.word_encode)])
def test_ids_are_the_librarys(path, encode, texts):
    for given in (noise(4000, 1), list(texts.values()), ["", " ", "a ", "  a"], []):
        assert lists(*encode(path, given)) == by_library(path, given)


def test_words_of_neighbouring_tokens():
    """Joined vocabulary entries, where longest match goes wrong often."""
    rng, names = random.Random(2), list(vocab.tokenizer(WORD_BPE).get_vocab())
    words = ["".join(rng.choice(names).replace("</w>", "") for _ in range(2)) for _ in range(8000)]
    assert lists(*bpe.word_encode(WORD_BPE, words)) == by_library(WORD_BPE, words)


def test_only_failing_words_are_merged(monkeypatch):
    model, merged = bpe.merges(WORD_BPE), []
    original = model.merge
    monkeypatch.setattr(model, "merge", lambda w: merged.append(w) or original(w))
    rng = random.Random(3)
    words = ["".join(rng.choice("aeinorsth") for _ in range(rng.randint(1, 12))).encode() for _ in range(3000)]
    model.encode(words)
    wrong = {w for w in words if model.propose(w) != original(w)}
    assert 0 < len(merged) < len(words)
    assert set(merged) == wrong


def test_pair_tests_agree():
    model, rng = bpe.merges(WORD_BPE), np.random.default_rng(4)
    a, b = (rng.integers(0, model.size - 2, 3000) for _ in range(2))
    assert model.compatible(a, b).tolist() == [model._walk(int(x), int(y)) for x, y in zip(a, b)]


def test_round_trip_and_awkward_rows(awkward, spark):
    done = bpe.decode(bpe.encode(awkward, WORD_BPE), WORD_BPE).collect()
    known = vocab.tokenizer(WORD_BPE)
    expected = [known.encode(r[1] or "", add_special_tokens=False).ids for r in ROWS]
    assert sorted((r["ids"], r["decoded"]) for r in done) == sorted(
        (ids, known.decode(ids, skip_special_tokens=False)) for ids in expected
    )
    assert bpe.encode(awkward.limit(0), WORD_BPE).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>")
    assert bpe.decode(nothing, WORD_BPE).first()["decoded"] is None


def test_every_prefix():
    known = vocab.tokenizer(WORD_BPE)
    given = [t for t in noise(300, 5) if "<|" not in t and "́" not in t] + ["ab<|endoftext|>c d", "<|endoftext|>"]
    for text in given:
        shown = text if "<|" in text else vocab.normalised(WORD_BPE, [text])[0]
        counts, starts = token_counts.prefix_counts(WORD_BPE, [text])
        prefixes = [shown[: i + 1] for i in range(len(shown))]
        assert counts.tolist() == [len(x) for x in by_library(WORD_BPE, prefixes)]
        assert starts.tolist() == [0, len(shown)]


def test_counts_and_budget(awkward, spark):
    done = token_counts.token_counts(awkward, WORD_BPE, limit=5).collect()
    assert len(done) == len(ROWS)
    assert sorted(r["n_tokens"] for r in done) == sorted(len(x) for x in by_library(WORD_BPE, [r[1] or "" for r in ROWS]))
    assert all(r["over_limit"] == (r["n_tokens"] > 5) for r in done)
    fox = next(r for r in done if r["doc_id"] == 1)
    text = ROWS[0][1]
    fits = [i for i in range(len(text) + 1) if len(by_library(WORD_BPE, [text[:i]])[0]) <= 5]
    assert fox["n_fit"] == max(fits)
    assert next(r for r in done if r["doc_id"] == 5)["n_bytes"] == 0
    assert token_counts.prefixes(awkward, WORD_BPE).where("doc_id = 3").first()["counts"] == []


def test_plan_is_tight_and_bounded():
    rng = random.Random(6)
    for capacity, many in ((10, 500), (1024, 5000)):
        counts: dict[int, int] = {}
        for _ in range(many):
            length = rng.randint(1, capacity)
            counts[length] = counts.get(length, 0) + 1
        slots = packing.plan(counts, capacity)
        held: dict[int, list] = {}
        for length, first, n, low, per, at in slots:
            for i in range(n):
                held.setdefault(low + i // per, []).append((at + i % per * length, length))
        assert {k: sum(n for size, _, n, *_ in slots if size == k) for k in counts} == counts
        for places in held.values():
            places.sort()
            assert [p for p, _ in places] == [sum(s for _, s in places[:i]) for i in range(len(places))]
            assert sum(s for _, s in places) <= capacity
        total = sum(k * v for k, v in counts.items())
        assert len(held) <= 1.01 * total / capacity + sum(v for k, v in counts.items() if k > capacity / 2) * 0.5
        assert len(packing.plan({k: v * 1000 for k, v in counts.items()}, capacity)) < 20 * capacity


def check_packing(rows, expected, capacity):
    by_doc, sequences = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc, pieces in by_doc.items():
        pieces.sort(key=lambda r: r["piece"])
        ids = b"".join(bytes(p["ids"]) for p in pieces)
        assert np.frombuffer(ids, "<u4").tolist() == expected[doc]
        assert [p["start"] for p in pieces] == [sum(q["length"] for q in pieces[:i]) for i in range(len(pieces))]
        assert all(p["length"] == capacity for p in pieces[1:])
    for places in sequences.values():
        places.sort()
        assert [p for p, _ in places] == [sum(s for _, s in places[:i]) for i in range(len(places))]
        assert sum(s for _, s in places) <= capacity
    return len(sequences)


def test_packing(sample, texts):
    expected = {i: ids + [2] for i, ids in zip(texts, by_library(BYTE_BPE, list(texts.values())))}
    rows = packing.pack(sample, BYTE_BPE, 512).collect()
    used = check_packing(rows, expected, 512)
    assert {r["doc_id"] for r in rows} == set(expected)
    assert used <= 1.02 * sum(map(len, expected.values())) / 512 + 1


def test_packing_awkward_rows(awkward):
    rows = packing.pack(awkward, BYTE_BPE).collect()
    expected = [x + [2] for x in by_library(BYTE_BPE, [r[1] or "" for r in ROWS])]
    assert sum(r["length"] for r in rows) == sum(map(len, expected))
    assert packing.pack(awkward.limit(0), BYTE_BPE).count() == 0


def test_variable_length_numbers():
    rng = np.random.default_rng(7)
    for n in (0, 1, 3, 4, 5, 1000):
        numbers = (rng.integers(0, 2**32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        control, data = token_file.to_bytes(numbers)
        assert len(control) == -(-n // 4)
        assert token_file.from_bytes(control, data, n).tolist() == numbers.tolist()


def test_frequent_ids_take_one_byte():
    ids = np.repeat(np.arange(40000, 40300, dtype=np.uint32), np.arange(300, 0, -1))
    order, rank = token_file.ranked(ids)
    assert order[:3].tolist() == [40000, 40001, 40002]
    assert (order[rank] == ids).all()
    assert len(token_file.to_bytes(rank)[1]) == len(ids) + (rank > 255).sum()


def test_token_files(sample, texts, spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    files = token_file.write(sample, BYTE_BPE, tokens_per_file=2000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert files.count() > 4
    ids = by_library(BYTE_BPE, [texts[i] for i in sorted(texts)])
    start, expected = 0, []
    for doc, x in zip(sorted(texts), ids):
        expected.append((doc, start, x + [2]))
        start += len(x) + 1
    rows = token_file.read(files).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["start"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()) for r in rows] == expected
    assert [r["n_tokens"] for r in rows] == [len(x) for _, _, x in expected]
    crc = token_file.read(files).where("doc_id = 0").select(F.crc32("ids")).first()
    first = next(x for d, _, x in expected if d == 0)
    assert crc is not None and crc[0] == zlib.crc32(np.array(first, "<u4").tobytes())


def test_token_files_awkward_rows(awkward):
    rows = token_file.read(token_file.write(awkward, BYTE_BPE)).orderBy("start").collect()
    assert len(rows) == len(ROWS)
    ends = [r["start"] + r["n_tokens"] for r in rows]
    assert [r["start"] for r in rows] == [0, *ends[:-1]]
    docs = [r["doc_id"] for r in rows]
    assert docs == sorted(docs, key=lambda d: (d is not None, d or 0))
    assert token_file.read(token_file.write(awkward.limit(0), BYTE_BPE)).count() == 0


def test_damaged_token_file(sample, tmp_path):
    name = token_file.write(sample, BYTE_BPE, str(tmp_path / "t")).first()["file"]
    data = bytearray(open(name, "rb").read())
    data[-1] ^= 1
    bad = tmp_path / "bad.tokens"
    bad.write_bytes(bytes(data))
    with pytest.raises(ValueError):
        token_file.file_rows(str(bad))
