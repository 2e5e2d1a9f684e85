"""Packing: whole pieces, gapless sequences, near the least number of them."""

import collections
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from retail_mart.llm import packing, queries, tokens
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def check_sequences(rows, size):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length >= 1
            at += length
        assert at <= size
    return len(by)


def test_open_bins_take_the_best_fit_and_close_the_fullest():
    rnd = random.Random(1)
    for _ in range(300):
        size, limit = rnd.choice([5, 16, 64]), rnd.choice([1, 3, 8])
        bins, got, want = packing.OpenBins(size, limit), [], []
        open_: list[list] = []  # [free, items], last touched last
        for k in range(rnd.randrange(60)):
            length = rnd.randint(1, size)
            got += [[i for i, _ in items] for _, items in bins.put(length, k)]
            fullest = lambda among: next(b for b in reversed(open_) if b[0] == min(x[0] for x in among))
            fits = [b for b in open_ if b[0] >= length]
            if not fits and len(open_) == limit:
                want.append(fullest(open_)[1])
                open_.remove(fullest(open_))
            b = fullest(fits) if fits else [size, []]
            if fits:
                open_.remove(b)
            b = [b[0] - length, [*b[1], k]]
            (want.append(b[1]) if b[0] == 0 else open_.append(b))
        assert got == want
        assert sorted(open_) == sorted([f, [i for i, _ in items]] for f, _, items in bins.rest())
        for _, _, items in bins.rest():
            assert items[0][1] == 0


def test_query_holds_every_id_once_and_few_sequences(spark, tokenizer):
    rows = queries.op12_packing(spark, SF_SMALL).collect()
    total, got = 0, collections.defaultdict(dict)
    for r in rows:
        got[r.doc_id][r.piece] = r
    for d in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        ids = np.array([*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 1], "<u4")
        total += len(ids)
        parts = [ids[k:k + 4096] for k in range(0, len(ids), 4096)]
        assert [(got[d.doc_id][k].start, got[d.doc_id][k].length, got[d.doc_id][k].ids_crc32) for k in range(len(parts))] \
            == [(4096 * k, len(p), zlib.crc32(p.tobytes())) for k, p in enumerate(parts)] and len(got[d.doc_id]) == len(parts)
    assert check_sequences(rows, 4096) <= -(-total // 4096) * 1.02 + 1


def test_later_rounds_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "LATE_IDS", 600)
    rnd = random.Random(2)
    docs = [(i, " ".join(rnd.choice("abcdefg") for _ in range(rnd.randrange(40)))) for i in range(3000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(12)
    rows = packing.pack(frame, queries.tokenizer_path(), size=50, open_bins=8).collect()
    total = sum(r.length for r in rows)
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter({i: 1 for i, _ in docs})
    assert total == sum(len(t.split()) + 1 for _, t in docs)
    assert check_sequences(rows, 50) <= 1.1 * total / 50  # tasks of a dozen sequences


def test_edge_cases(spark, edge, none, tokenizer):
    assert packing.pack(none, queries.tokenizer_path()).count() == 0
    rows = packing.pack(edge, queries.tokenizer_path()).collect()
    check_sequences(rows, 4096)
    n = lambda t: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
    want = collections.Counter()
    for d in edge.collect():
        want[d.doc_id] += n(d.text)
    got = collections.Counter()
    for r in rows:
        got[r.doc_id] += r.length
        assert r.length * 4 == len(r.ids) and r.start == 4096 * r.piece
    assert got == want and got[4] == 1
    only = packing.pack(edge.filter(F.col("doc_id") == 10), queries.tokenizer_path()).collect()
    assert sorted(r.length for r in only)[1:] == [4096] * (len(only) - 1) and len({r.sequence_id for r in only}) == len(only)


def test_ids_of_random_letters_are_the_tokenizers(tokenizer):
    enc, rnd = tokens.Encoder(queries.tokenizer_path()), random.Random(5)
    letters = [chr(c) for c in range(0xC0, 0x180)] + ["İ"] * 20 + list("aZsT0 .,'-!̇́ \n")
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(12))) for _ in range(100_000)]
    texts += ["BELEDİYESİ.", "Sİ:", "AKBİ, İ-posta"]
    for text, e in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert enc.ids(text).tolist() == [*e.ids, 1], text


def test_another_tokenizer_encodes_whole_texts():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("byte_bpe_50k.json")
    other, enc = Tokenizer.from_file(path), tokens.Encoder(path)
    assert not enc.in_parts
    for text in ("Hello  World, it's\tUP", "", None, "İx <|endoftext|>"):
        assert enc.ids(text).tolist() == [*other.encode(text or "", add_special_tokens=False).ids, 1]
