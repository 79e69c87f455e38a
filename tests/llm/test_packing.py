import random
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pitpanel.llm import packing
from pitpanel.llm.packing import best_fit, encoder, pack_documents, packed_sequences, pattern_plan

SCHEMA = "doc_id long, text string, length string, sequence_id string"


def texts():
    draw = random.Random(4)
    words = "alpha Beta gämma δ 12 345 it's we'll ... \n\n  x y 日本語 🙂".split(" ")
    out = [" ".join(draw.choice(words) for _ in range(draw.choice([1, 5, 40, 200, 700]))) for _ in range(60)]
    return out + ["", None, " ", "a" * 30_000, "<|endoftext|> and <|endoftext|>", "same", "same"]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_tokenizer_file(reference):
    mine = encoder("byte_bpe_50k.tiktoken")
    for text in texts():
        want = reference.encode(text or "", add_special_tokens=False).ids
        assert mine.encode(text or "", allowed_special="all") == want


def test_pieces_and_places(spark, reference):
    rows = list(enumerate(texts())) + [(7, "same id"), (None, "no id")]
    df = spark.createDataFrame([(k, t, "a", "b") for k, t in rows], SCHEMA).repartition(3)
    got = pack_documents(df).collect()
    want = []
    for key, text in rows:
        ids = reference.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        cuts = [0] + list(range(first, len(ids) + 1, 1024)) if len(ids) > 1024 else [0, len(ids)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((key, i, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= 1024
    assert len(bins) <= -(-sum(r.length for r in got) // 1024) + 2


def test_sequences_hold_the_ids(spark, reference):
    df = spark.createDataFrame([(k, t, "a", "b") for k, t in enumerate(texts()[:20])], SCHEMA)
    for row in packed_sequences(df).collect():
        ids = list(struct.unpack(f"<{len(row.ids) // 4}I", bytes(row.ids)))
        for part in row.documents:
            assert part.length == sum(1 for _ in ids[part.offset : part.offset + part.length])
    total = sum(len(r.ids) // 4 for r in packed_sequences(df).collect())
    assert total == sum(len(reference.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts()[:20])


@pytest.mark.parametrize("seed", range(4))
def test_plans_use_every_length_once_and_pack_tightly(seed):
    draw = random.Random(seed)
    counts = defaultdict(int)
    for _ in range([50, 3000, 60_000, 400_000][seed]):
        counts[min(1024, max(1, int(draw.lognormvariate(5.5, 0.9))))] += 1
    plan = pattern_plan(dict(counts))
    used = defaultdict(int)
    for pattern, repeats in plan.items():
        assert sum(pattern) <= 1024 and repeats > 0
        for length in pattern:
            used[length] += repeats
    assert used == counts
    least = -(-sum(k * v for k, v in counts.items()) // 1024)
    assert sum(plan.values()) <= least * 1.01 + 2


def test_best_fit_by_hand():
    assert best_fit({6: 1, 5: 1, 4: 1, 3: 1}, 10) == {(6, 4): 1, (5, 3): 1}
    assert best_fit({}, 10) == {} and best_fit({3: 7}, 10) == {(3, 3, 3): 2, (3,): 1}


def test_an_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000, "a" * 2_000_000, "b " + "\t" * 300_000 + "c", "-" * 200_000 + "x"])
def test_very_long_runs_give_the_ids_of_tokenizers(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.token_ids(text).tolist() == other.encode(text, add_special_tokens=False).ids


def test_documents_of_blanks_are_packed(spark):
    docs = spark.createDataFrame([(1, " " * 1_500_000), (2, "x"), (3, None)], "doc_id long, text string")
    rows = packing.pack_documents(docs).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 1_500_001
