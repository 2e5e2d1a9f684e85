"""Each operator against brute force or an exact round trip, and on the edge cases."""

import base64
import collections
import hashlib
import io
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from retail_mart.llm import decontam, langid, lm_score, mixing, order_minhash, queries, quotes, secrets, token_blocks, tokens, topk, warc
from retail_mart.llm.common import components, words
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def test_words_are_those_of_the_regular_expression(spark, edge):
    for r in [*docs(spark).limit(100).collect(), *edge.collect()]:
        assert [w.decode() for w in words(r.text)] == re.findall(r"\w+", (r.text or "").lower())


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (9, 3), (5, 6), (8, 7), (7, 6)], "a long, b long")
    assert {r.node: r.label for r in components(e, spark).collect()} == {1: 1, 2: 1, 3: 1, 9: 1, 5: 5, 6: 5, 7: 5, 8: 5}


# 1 mixing

def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(sizes), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 3 * sizes[s] + 1e-9]
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            free.remove(s)
        left = sum(sizes.values()) - sum(target.values())
    return target


def test_mixing_meets_brute_force_targets(spark, edge):
    for frame, near in ((docs(spark), 0.05), (edge, None)):
        rows = frame.collect()
        got = mixing.mix(frame).collect()
        sizes = collections.Counter()
        for r in rows:
            sizes[r.source] += len(WORD.findall(r.text or ""))
        target = brute_targets(sizes)
        taken = collections.Counter()
        for r in got:
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source], abs=1e-6)
            assert r.taken == r.copies * r.size <= 3 * r.size
            taken[r.source] += r.taken
        assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((r.doc_id or -1, len(WORD.findall(r.text or ""))) for r in rows)
        if near:
            # ten documents a source here: what is left is less than half a document
            for s in sizes:
                some = sorted(len(WORD.findall(r.text or "")) for r in rows if r.source == s)
                assert abs(taken[s] - target[s]) <= max(near * target[s], some[-1] / 2)


def test_mixing_rates_are_tilted_and_meet_the_targets(spark):
    """lambda solves the constraint over all documents; copies stay next to the rate."""
    rnd = random.Random(11)
    rows = [(i, " ".join(["w"] * int(rnd.lognormvariate(3, 1) + 1)), f"s{rnd.choice('aaabbc')}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = {r.source: r for r in mixing.plan(mixing._rows(frame, "doc_id", "text", "source").select("source", "size", "h")).collect()}
    size = {i: len(t.split()) for i, t, _ in rows}
    got = {r.doc_id: r for r in mixing.mix(frame).collect()}
    for s, p in plan.items():
        own = [i for i, _, src in rows if src == s]
        assert p.mean == pytest.approx(sum(size[i] for i in own) / len(own))
        rate = {i: 3.0 if p.lam is None else min(3.0, float(np.exp(p.lam * size[i] / p.mean))) for i in own}
        assert sum(rate[i] * size[i] for i in own) == pytest.approx(p.target, rel=1e-6)
        assert sum(got[i].copies not in (int(rate[i]), int(rate[i]) + 1) for i in own) <= 5
        smallest = min(size.values())
        assert abs(sum(got[i].taken for i in own) - p.target) <= smallest
    assert len({round(p.lam, 6) for p in plan.values() if p.lam is not None}) > 1


def test_a_blocking_document_does_not_keep_a_source_from_its_target(spark):
    """One document of 20,000 words, 1,000 of 20 words: the error stays below the short ones' size."""
    short, long_ = "w " * 20, "w " * 20_000
    for sources in ("ab", "abc", "abcd"):
        rows = [(1000 * k + i, long_ if i == 0 else short, s) for k, s in enumerate(sources) for i in range(1001)]
        rows += [(10**6 + i, "w " * (3000 + 17 * i), "z") for i in range(40)]
        taken, target = collections.Counter(), {}
        for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
            taken[r.source] += r.taken
            target[r.source] = r.target
        for s in sources:
            assert abs(taken[s] - target[s]) <= 20, (s, taken[s], target[s])
        assert abs(taken["z"] - target["z"]) <= 3000


def test_mixed_repeats_rows_as_planned(spark, edge, none):
    plan = collections.Counter()
    for r in mixing.mix(edge).collect():
        plan[r.doc_id] += r.copies
    got = collections.Counter(r.doc_id for r in mixing.mixed(edge).collect())
    assert got == +plan and mixing.mixed(edge).columns == edge.columns
    assert mixing.mix(none).count() == mixing.mixed(none).count() == 0


# 2 top-k

def test_topk_is_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([-1.0, -0.5, 0.25, rnd.uniform(-1, 1)]) for _ in range(6)]) for i in range(400)]
    rows += [(50, rows[50][1]), (900, None), (901, [None] * 6), (902, [float("nan")] * 6), (903, [float("inf")] + [0.0] * 5), (904, [1.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for r in topk.top_k(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    v = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in e]) for i, e in rows if i is not None and i < 900]
    for q in range(0, 400, 50):
        own = dict(v)[q]
        best = sorted((-sum(a * b for a, b in zip(own, e, strict=True)), i) for i, e in v if i != q)[:5]
        assert got[q] == [(i, -s) for s, i in best]
    assert set(got) == set(range(0, 400, 50))
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0


# 3 near duplicates

def slow_distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def test_banded_distance_is_the_whole_tables():
    rnd = random.Random(1)
    for _ in range(800):
        a = [bytes([rnd.randrange(97, 101)]) for _ in range(rnd.randrange(30))]
        b = list(a) if rnd.random() < 0.6 else a[::-1]
        for _ in range(rnd.randrange(6)):
            k = rnd.randrange(len(b) + 1)
            b[k:k + rnd.randrange(2)] = [b"z"] * rnd.randrange(2)
        d, most = slow_distance(a, b), rnd.randrange(15)
        assert order_minhash.edit_distance(a, b, most) == (d if d <= most else None)


def test_planted_copies_meet_and_clean_documents_do_not(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    passage = [word() for _ in range(100)]
    rows, truth = [], {}
    for g in range(12):
        base = [word() for _ in range(150)]
        for c in range(4):
            w = list(base)
            for _ in range(3 * (c > 0)):
                w[rnd.randrange(150)] = word()
            rows.append((len(rows), " ".join(w)))
            truth[len(rows) - 1] = g
    for _ in range(40):  # share a long passage, nothing else
        rows.append((len(rows), " ".join(passage + [word() for _ in range(60)])))
        truth[len(rows) - 1] = len(rows) + 100
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    first = {}
    for d, g in truth.items():
        assert got[d] == first.setdefault(g, d)


def test_near_duplicates_on_edge_cases(spark, edge, none):
    got = {(r.doc_id, r.class_id, r.class_size) for r in order_minhash.near_duplicates(edge).collect()}
    assert {(1, 1, 4), (2, 1, 4), (3, 1, 4), (4, 4, 1), (5, 5, 1), (8, 8, 1), (None, None, 1)} <= got
    kept = order_minhash.deduplicated(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 8, 9, 10, 11, 12]
    twice = order_minhash.deduplicated(edge.union(edge)).collect()
    assert sorted(r.doc_id or 0 for r in twice) == [0, 1, 4, 4, 5, 6, 8, 9, 10, 11, 12]  # null texts stay
    assert order_minhash.near_duplicates(none).count() == 0


def test_candidates_reach_the_threshold():
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6)).encode()
    for n, changed, least in ((300, 0.10, 0.99), (300, 0.15, 0.95), (300, 0.20, 0.85), (20, 0.20, 1.0), (12, 0.16, 1.0), (38, 0.18, 1.0)):
        met = 0
        for _ in range(100):
            a = [word() for _ in range(n)]
            b = list(a)
            for i in rnd.sample(range(n), int(changed * n)):
                b[i] = word()
            assert order_minhash.similarity(a, b) is not None
            met += bool(np.isin(order_minhash.text_keys(b" ".join(a)), order_minhash.text_keys(b" ".join(b))).any())
        assert met >= 100 * least, (n, changed, met)


def test_short_texts_meet_as_by_brute_force(spark):
    base = "red green blue white black brown pink grey gold".split()
    texts = [base[:n] for n in range(3, 10)]
    texts += [[*base[:i], "other", *base[i + 1:n]] for n in (4, 5, 6, 9) for i in range(n)]
    texts += [["new", *base[2:8]], ["x1", "x2", "x3", "x4", "x5"], ["x1", "x2", "y3", "x4", "x5"], ["x1", "x2", "x3", "x4", "x5", "x6"]]
    of = list(range(len(texts)))
    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:i]):
            if order_minhash.similarity([w.encode() for w in a], [w.encode() for w in b]) is not None:
                x, y = of[i], of[j]
                of = [min(x, y) if k in (x, y) else k for k in of]
    got = order_minhash.near_duplicates(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string"))
    assert {r.doc_id: r.class_id for r in got.collect()} == dict(enumerate(of))


# 4 WARC

PAGES = "page_id long, url string, html string, d string, best string"


def test_archives_return_every_page(spark):
    rows = [(i, f"http://x/{i % 7}", f"<p>{i % 5}</p>" * (i % 5 + 1), None, "x") for i in range(40)]
    rows += [(None, None, "<p>0</p>", None, None), (90, "a b\nc", None, None, None), (91, "u", "", None, None), (92, "u", "é" * 300_000, None, None),
             (93, "u", "same", None, None), (93, "u", "same", None, None), (93, "v", "same", None, None)]
    pages = spark.createDataFrame(rows, PAGES)
    got = warc.archive_round_trip(pages).collect()
    best = {}
    for r in rows:
        p = (r[2] or "").encode()
        best[p] = max(best.get(p, -1), -1 if r[0] is None else r[0])
    want = collections.Counter()
    for r in rows:
        p = (r[2] or "").encode()
        response = r[0] is not None and best[p] == r[0]
        want[r[0], len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if response else "revisit", None if response else best[p]] += 1
    digest = base64.b32encode(hashlib.sha1(b"same").digest()).decode()
    want[93, 4, digest, "response", None] = 1  # of equal rows one is the response
    want[93, 4, digest, "revisit", 93] = 2
    assert collections.Counter(tuple(r)[:1] + tuple(r)[2:] for r in got) == want
    assert warc.archive_round_trip(pages.limit(0)).count() == 0
    back = warc.read_archives(warc.write_archives(pages, queries.warc.run_dir(spark, "warc"), min_bytes=1 << 30), payloads=True).collect()
    assert sorted(bytes(r.payload) for r in back) == sorted((r[2] or "").encode() for r in rows)


def test_broken_archives_are_refused():
    f = io.BytesIO()
    w = warc.ArchiveWriter(f, warc.train([b"<html>" * 50] * 20))
    record = warc.encode_record(warc.Page(1, "http://x", b"payload"), "n")
    w.add(record)
    raw = f.getvalue()
    assert [warc.decode_record(r).payload for r in warc.read_archive(io.BytesIO(raw))] == [b"payload"]
    for bad in (raw[8:], raw[:-3], b"", raw[:-10] + b"x" * 10):
        with pytest.raises(ValueError):
            list(warc.read_archive(io.BytesIO(bad)))
    for old, new in ((b"payload", b"paylood"), (b"WARC/1.1", b"WARC/9"), (b"WARC-Date", b"WARC Date"), (b"\r\n\r\n", b"\r\n")):
        with pytest.raises(ValueError):
            warc.decode_record(record.replace(old, new))


# 5 tokens

def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 127, 128, 129, 5000):
        for high in (1, 2, 300, 49407, 2**32 - 1):
            x = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
            x[rng.random(n) < 0.05] = high
            raw, sizes = token_blocks.encode_blocks(x)
            assert (token_blocks.decode_blocks(raw, np.cumsum(sizes) - sizes) == x).all()


def test_token_files_are_the_tokenizers_ids(spark, edge, none):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    t = Tokenizer.from_file(path)
    more = [(20, "it's a TEST, don't \"quote\" x.y 12a34 <|endoftext|> end"), (21, "á …“x”. Ǆ ﬁ İ"), (22, "'s'tail 'sound l'été, 3'd!!?")]
    frame = edge.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string")).union(docs(spark).select("doc_id", "text"))
    want, at = [], 0
    for r in sorted(frame.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        ids = np.array(t.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((r.doc_id, len(ids), zlib.crc32(ids.tobytes())))
    got = tokens.encode_corpus(frame, path).orderBy("start").collect()
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == collections.Counter(want)
    assert [r.doc_id for r in got] == [w[0] for w in want]
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert tokens.encode_corpus(none, path).count() == 0


def test_reader_seeks_any_run(tmp_path):
    x = np.random.default_rng(2).integers(0, 50_000, 300_000).astype(np.uint32)
    with open(tmp_path / "s", "wb") as f:
        w = token_blocks.ShardWriter(f)
        for k in range(0, len(x), 70_000):
            w.add(k, x[k:k + 70_000])
        w.close()
    with open(tmp_path / "s", "rb") as f:
        r = token_blocks.ShardReader(f)
        assert (r.ids(123_456, 1000) == x[123_456:124_456]).all()
        assert list(r.crcs()) == [zlib.crc32(x[k:k + 70_000].tobytes()) for k in range(0, len(x), 70_000)]


# 6 language

def test_language_of_held_out_rows(spark):
    d = docs(spark)
    got = langid.predict(d.select("doc_id", "text", "lang"), langid.fit(d, ~langid.held_out())).filter(langid.held_out()).collect()
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == r.lang for r in got) >= 0.97 * len(got)


def test_ppm_code_lengths_are_those_of_the_definition():
    model = langid.PPM({"x": [b"abracadabra", b"abab"], "y": [b"zyzzyva"]})

    def bits(samples, text):
        seen = collections.defaultdict(collections.Counter)
        for s in samples:
            s = b"\n" * 3 + s
            for i in range(3, len(s)):
                for k in range(4):
                    seen[s[i - k:i]][s[i]] += 1
        total, text = 0.0, b"\n" * 3 + text
        for i in range(3, len(text)):
            for k in (3, 2, 1, 0, -1):
                c = seen[text[i - k:i]] if k >= 0 else None
                if c is None:
                    total += 8
                elif c:
                    n = sum(c.values()) + len(c)
                    if text[i] in c:
                        total -= np.log2(c[text[i]] / n)
                        break
                    total -= np.log2(len(c) / n)
        return total

    for text in (b"abra", b"zyz", b"cadabraz", b"\n", b"aaaaaaaaaazzzzzzzzzy"):
        got = model.bits([text])[0]
        assert got == pytest.approx([bits([b"abracadabra", b"abab"], text), bits([b"zyzzyva"], text)], rel=1e-5)


def test_a_language_of_long_texts_only_is_learned(spark):
    """Whole long texts, one at least, however short the budget."""
    rnd = random.Random(8)
    word = lambda letters: "".join(rnd.choice(letters) for _ in range(rnd.randint(3, 8)))
    rows = [(i, " ".join(word("abcdefg") for _ in range(60)), "short") for i in range(60)]
    rows += [(100 + i, " ".join(word("opqrstu") for _ in range(5000)), "long") for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.predict(frame, langid.fit(frame, ~langid.held_out())).filter(langid.held_out()).collect()
    assert {r.lang for r in got} == {"short", "long"} and all(r.lang_pred == r.lang and r.score > 0.9 for r in got)


def test_any_number_of_languages_in_groups(spark, monkeypatch):
    rnd = random.Random(9)
    rows = []
    for k in range(70):
        letters = [chr(0x4E00 + 3 * k + j) for j in range(3)]
        rows += [(100 * k + i, "".join(rnd.choice(letters) for _ in range(80)), f"l{k:02d}") for i in range(8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = langid.fit(frame, ~langid.held_out())
    assert len(models) == 5 and sum(len(m.langs) for m in models) == 70
    got = langid.predict(frame, models).collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.99 * len(got)
    monkeypatch.setattr(langid, "LANGS_AT_ONCE", 100)
    whole = {r.doc_id: r for r in langid.predict(frame, langid.fit(frame, ~langid.held_out())).collect()}
    for r in got:
        assert r.lang_pred == whole[r.doc_id].lang_pred and r.score == pytest.approx(whole[r.doc_id].score, rel=1e-4)


def test_training_rows_are_the_first_hashes(spark, monkeypatch):
    rows = [(i, f"text {i} " * (1 + i % 7), "en" if i % 3 else "de") for i in range(3000)] + [(9, "same", "fr")] * 50
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    hashed = {(r.lang, r.h, r.n) for r in frame.select("lang", F.xxhash64("text").alias("h"), F.length("text").alias("n")).collect()}
    for docs_, chars in ((40, 10**9), (10**9, 900), (1, 1)):
        monkeypatch.setattr(langid, "DOCS_PER_LANG", docs_)
        monkeypatch.setattr(langid, "LANG_CHARS", chars)
        want = {}
        for lang in ("en", "de", "fr"):
            k = n = 0
            for _, h, length in sorted(x for x in hashed if x[0] == lang):
                if k >= docs_ or n >= chars:
                    break
                want[lang], k, n = h, k + 1, n + length
        assert {r.lang: r.h for r in langid._training_rows(frame).collect()} == want


def test_language_on_edge_cases(spark, edge, none):
    model = langid.fit(edge, F.lit(True))
    got = langid.predict(edge, model)
    assert got.columns == [*edge.columns, "lang_pred", "score"]
    rows = {r.doc_id: r for r in got.collect()}
    assert all((rows[k].lang_pred, rows[k].score) == ("und", 0.0) for k in (4, 5, 6, 8))
    assert rows[9].lang_pred == "de" and rows[1].lang_pred == "en" and 0 <= rows[12].score <= 1
    assert langid.keep_identified(edge, model).columns == edge.columns
    assert {r.lang_pred for r in langid.predict(edge, langid.fit(none, F.lit(True))).collect()} == {"und"}
    assert langid.predict(none, model).count() == 0


# 7 scoring

def test_scores_are_those_of_the_definition(spark, edge, monkeypatch):
    labels = spark.createDataFrame([(1,), (1,), (9,), (None,), (77,)], "doc_id long")
    got = lm_score.score(edge, labels).collect()
    texts = [(r.doc_id, (r.text or "").lower().encode()) for r in edge.collect()]
    counts = {"t": collections.Counter(), "b": collections.Counter()}
    for d, raw in texts:
        s = b"\n\n\n" + raw
        for i in range(3, len(s)):
            for k in range(4):
                counts["b"][s[i - k:i + 1]] += 1
                counts["t"][s[i - k:i + 1]] += d in (1, 9)
    seen = {m: collections.defaultdict(lambda: [0, 0]) for m in counts}
    for m, c in counts.items():
        for g, n in c.items():
            seen[m][g[:-1]][0] += n
            seen[m][g[:-1]][1] += n > 0

    def p(m, g):
        low = p(m, g[1:]) if len(g) > 1 else 1 / 256
        n, d = seen[m][g[:-1]]
        return (counts[m][g] + d * low) / (n + d) if n else low

    want = collections.defaultdict(list)
    for d, raw in texts:
        s = b"\n\n\n" + raw
        if len(raw) < 5000:
            loss = [sum(-np.log2(p(m, s[i - 3:i + 1])) for i in range(3, len(s))) / len(raw) if raw else None for m in "tb"]
            want[d].append((len(raw), *loss))
    for r in got:
        if r.n_tokens < 5000:
            w = want[r.doc_id][0]
            assert r.n_tokens == w[0]
            assert (r.target_loss, r.background_loss) == (pytest.approx(w[1], rel=1e-4), pytest.approx(w[2], rel=1e-4)) if w[0] else r.score is None
    assert len(got) == edge.count()


def test_pieces_do_not_change_scores(spark, edge, monkeypatch):
    labels = spark.createDataFrame([(1,)], "doc_id long")
    whole = sorted((r.doc_id or 0, r.n_tokens, round(r.score or 0, 6)) for r in lm_score.score(edge, labels).collect())
    rows = list(lm_score._pack_rows(iter(edge.select("doc_id", "text").toArrow().to_batches())))
    monkeypatch.setattr(lm_score, "PIECE", 1000)
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 5000)
    cut = list(lm_score._pack_rows(iter(edge.select("doc_id", "text").toArrow().to_batches())))
    assert len(cut) > 10 * len(rows) and len(whole) == edge.count()

    def grams(batches):
        out = collections.Counter()
        for row in (r for b in batches for r in b.to_pylist()):
            for g, piece in lm_score._grams(row["body"], row["sizes"]):
                out.update(zip((row["ids"][p] for p in piece.tolist()), g.tolist(), strict=True))
        return out

    of_pieces = grams(cut)
    assert grams(rows) == of_pieces
    for chunk in (7, 700):
        monkeypatch.setattr(lm_score, "CHUNK", chunk)
        assert grams(cut) == of_pieces


# 8 secrets

def test_secret_scan_finds_planted_secrets(spark):
    rnd = random.Random(4)
    hexes = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    rows = []
    for i in range(60):
        rows.append((i, f'some words here token = "{hexes(40)}" and more words'))
        rows.append((100 + i, f"card {rnd.randrange(10**15, 10**16)} or /usr/lib/{hexes(4)}/share/of/path{i} in prose"))
    rows += [(300, None), (301, ""), (302, "nothing here")]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text = dict(rows)
    for r in got:
        assert hashlib.sha256(text[r.doc_id][r.start:r.start + r.length].encode()).hexdigest() == r.value_sha256
    assert {r.doc_id for r in got if r.secret} == set(range(60))
    assert {r.doc_id for r in got} >= {100 + i for i in range(60)}


def test_secret_scan_without_two_classes(spark, edge, none):
    assert secrets.scan(none).count() == 0
    got = secrets.scan(spark.createDataFrame([(1, "id 1234567890123456 x")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.start, r.score, r.secret) for r in got] == [(1, 3, None, True)]
    assert secrets.scan(edge).count() == 0


def test_secret_scan_knows_other_forms(spark):
    rnd = random.Random(5)
    key = lambda n, of="abcdefghijkmnpqrstuvwxyz23456789ABCDEFGHJKLMNPQRSTUVWXYZ": "".join(rnd.choice(of) for _ in range(n))
    letters = "bcdfghjklmnpqrstvwxz"
    forms = ['client_secret = "{}"', "access_token: '{}'", "aws_secret_access_key = {}", "API_KEY={}", "db-password: {}",
             "Authorization: Bearer {}", '{{"clientSecret": "{}"}}', 'export SERVICE_TOKEN={}==']
    rows, want = [], {}
    for i in range(160):
        value = key(16, letters) if i % 3 == 0 else key(10) if i % 3 == 1 else key(40)
        form = forms[i % len(forms)]
        rows.append((i, "some words of plain prose here " + form.format(value) + " and more words"))
        want[i] = value + ("==" if form.endswith("==") else "")
        rows.append((1000 + i, f"card {rnd.randrange(10**15, 10**16)} or /usr/lib/{key(4, '0123456789abcdef')}/share/of/path{i} in plain prose"))
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text = dict(rows)
    found = {r.doc_id: text[r.doc_id][r.start:r.start + r.length] for r in got if r.secret}
    assert found == want
    assert {r.doc_id for r in got} >= {1000 + i for i in range(160)}


def test_secret_dictionary_counts_all_texts(spark):
    rows = [(i, "word " * 5_000 if i else "prose " * 100) for i in range(600)] + [(999, "later " * 9_000)]
    known = {r.trigram for r in secrets.dictionary(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert known == {"wor", "ord", "lat", "ate", "ter"}


# 9 decontamination

def test_contained_items_are_brute_force(spark, edge, none):
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    sets = lambda t: {tuple(w[k:k + 5]) for w in [words(t)] for k in range(len(w) - 4)}
    want, bench = set(), {r.item_id: sets(r.text) for r in items.collect()}
    for r in docs(spark).collect():
        own = sets(r.text)
        want |= {(r.doc_id, i) for i, s in bench.items() if s and len(own & s) >= 0.8 * len(s)}
    got = {(r.doc_id, r.item_id) for r in decontam.contained_items(docs(spark), items).collect()}
    assert got == want and want
    left = {r.doc_id for r in decontam.decontaminate(docs(spark), items).collect()}
    assert left == {r.doc_id for r in docs(spark).collect()} - {d for d, _ in want}
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "too short"), (4, "quick brown fox jumps over the lazy")], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontam.contained_items(edge, odd).collect()] == [(None, 4)]
    assert decontam.decontaminate(edge, odd).count() == edge.count() - 1
    assert decontam.contained_items(none, odd).count() == decontam.contained_items(edge, odd.limit(0)).count() == 0


def test_every_containing_document_holds_a_sketch_hash():
    rng = np.random.default_rng(3)
    for _ in range(300):
        s = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 60)), dtype=np.int64).view(np.uint64))
        ix = decontam.ItemIndex([(1, s)], 0.8)
        part = rng.permutation(s)[:int(np.ceil(0.8 * len(s) - 1e-9))]
        assert ix.search(part)[0].tolist() == [0]
        assert ix.search(part[:-1])[0].tolist() == ([0] if len(part) - 1 >= 0.8 * len(s) - 1e-9 else [])


# 10 quotes

def test_quotes_link_replies(spark):
    rows = [("a", "s", 1, "Hello all,\nwhat is new?"), ("b", "s", 2, "Not much.\n\nOn Monday they wrote:\n> hello  ALL,\n> What is new?"),
            ("c", "s", 3, "I see.\n> Not much.\n>> Hello all,\n>> what is new?"), ("d", "t", 4, "Elsewhere\n> Not much."), ("e", "s", 5, None),
            ("f", "s", 0, "too early\n> Hello all,"), ("c", "s", 3, "I see.\n> Not much.\n>> Hello all,\n>> what is new?"), ("g", None, None, "> \n>\nx")]
    got = {r.msg_id: tuple(r)[1:] for r in quotes.conversations(spark.createDataFrame(rows, "msg_id string, scope string, ord long, text string")).collect()}
    assert got == {"a": (None, "a", 0, 1, "Hello all,\nwhat is new?"), "b": ("a", "a", 1, 2, "Not much."), "c": ("b", "a", 2, 3, "I see."),
                   "d": (None, "d", 0, 4, "Elsewhere"), "e": (None, "e", 0, 5, ""), "f": (None, "f", 0, 0, "too early"), "g": (None, "g", 0, None, "x")}
    parsed = quotes.parse(spark.createDataFrame(rows, "msg_id string, scope string, ord long, text string"))
    assert {(r.msg_id, r.level): r.source for r in quotes.links(parsed).collect()} == {("b", 1): "a", ("c", 1): "b", ("c", 2): "a"}
    assert quotes.conversations(spark.createDataFrame([], "msg_id string, scope string, ord long, text string")).count() == 0


def test_quotes_link_repeated_replies_to_their_own_message(spark):
    rows = [("1", "s", 1, "Is it raining?"), ("2", "s", 2, "Yes.\n> Is it raining?"), ("3", "s", 3, "Do you stay?\n> Yes.\n>> Is it raining?"),
            ("4", "s", 4, "Yes.\n> Do you stay?\n>> Yes."), ("5", "s", 5, "Fine.\n> Yes.\n>> Do you stay?"),
            ("6", "s", 6, "Take a coat.\n> Yes.\n>> Is it raining?"), ("7", "s", 7, "Good.\n> Yes."),
            ("8", "s", 90_000, "Late.\n> Take a coat."), ("9", "s", 90_001, "Really late.\n> Yes.")]
    got = {r.msg_id: (r.reply_to, r.root, r.depth) for r in
           quotes.conversations(spark.createDataFrame(rows, "msg_id string, scope string, ord long, text string")).collect()}
    assert got == {"1": (None, "1", 0), "2": ("1", "1", 1), "3": ("2", "1", 2), "4": ("3", "1", 3), "5": ("4", "1", 4), "6": ("2", "1", 2),
                   "7": ("4", "1", 4), "8": ("6", "1", 3), "9": ("4", "1", 4)}


def test_words_of_letters_go_to_the_model(monkeypatch):
    """New words skip the tokenizer's normalizer and splits; the ids are those of the whole text."""
    from tokenizers import Tokenizer

    from retail_mart.llm.queries import tokenizer_path
    from retail_mart.llm.tokens import END_ID, Encoder
    whole = Tokenizer.from_file(tokenizer_path())
    letters = [chr(c) for c in [*range(0x41, 0x5B), *range(0xC0, 0x180)]]
    texts = [f"{c} a{c}b {c}{c}" for c in letters] + ["Don't l'Été d'Œuvre x2y 3rd ½ ́e ﬁn Ω"]
    e = Encoder(tokenizer_path())
    assert [e.ids(t).tolist() for t in texts] == [[*whole.encode(t, add_special_tokens=False).ids, END_ID] for t in texts]
    e = Encoder(tokenizer_path())
    monkeypatch.setattr(e, "tokenizer", type("ModelOnly", (), {"model": e.tokenizer.model})())
    assert len(e.ids("plain words naïve Ärger")) > 4
