"""Operators of wardflow.llm against brute force, exact round trips and SQL."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from oracle import compare, duck
from wardflow.llm import (bloom_lm, common, crf_language, decontaminate, hyperminhash, id_coder, line_dedup, queries, source_mix,
                          token_counts, token_output, toxicity, voronoi_knn)

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size int, score string, h string, pos int, rank int, "
          "prediction int, features string, item_id long")
LONG = " ".join(f"w{i % 700}" for i in range(60_000))
ROWS = [(1, "one two three four five six seven eight nine ten", "en", "b"), (2, None, None, None), (3, "", "en", "a"), (None, "no id here at all", None, "a"),
        (4, "one two three four five six seven eight nine ten", "en", "a"), (4, "one two three four five six seven eight nine ten", "en", "a"),
        (5, " \n\t ", "de", "a"), (6, LONG, "en", "b"), (7, LONG + " tail", "en", None), (8, "a\nb\nc\nd", "fr", "a"), (9, "x\na\nb\nc", "fr", "a"),
        (None, None, None, None), (10, "123 !!! ...", "es", "a"), (11, "short", "es", "c"), (11, "other text under one id", "es", "c")]
TOKENIZER = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), 5, "s", "h", 1, 2, 0, "f", 3) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return common.table(spark, SF, "documents")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    ok, message = compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLE[name])
    assert ok, message


def words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def test_word_hashes_follow_the_words():
    texts = ["A b\tc", "", "b  B\nÉ é", " "]
    h, at = common.word_hashes(common.encoded(texts))
    assert np.diff(at).tolist() == [len(words(t)) for t in texts]
    flat = [w for t in texts for w in words(t)]
    assert len(set(h.tolist())) == len(set(flat)) and h[1] == h[3] == h[4]


# 1 line dedup

def test_line_dedup_edges(odd, none):
    d = line_dedup.drop_repeated_lines(odd)
    assert set(d.columns) == {*odd.columns, "n_lines", "n_removed"}
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in d.collect()}
    assert d.count() == len(ROWS) and got[8] == ("a\nb\nc\nd", 4, 0) and got[9] == ("x", 4, 3) and got[2] == (None, 0, 0) and got[3] == ("", 1, 0)
    assert line_dedup.drop_repeated_lines(none).count() == 0


# 2 token ids

@pytest.mark.parametrize("n", [0, 1, 2, 4095, 4096, 4097, 9000])
def test_coder_round_trip(n):
    r = np.random.default_rng(n)
    for ids in (r.integers(0, 50257, n), r.zipf(1.3, n) % 50257, np.zeros(n, int), np.full(n, 50256)):
        payload, crcs = id_coder.encode(ids, 50257)
        assert (id_coder.decode(payload, crcs, n, 50257) == ids).all()


def test_coder_blocks_stand_alone_and_are_checked():
    ids = np.random.default_rng(3).zipf(1.4, 9000) % 5000
    payload, crcs = id_coder.encode(ids, 5000)
    assert (id_coder.decode(payload[1:2], crcs[1:2], id_coder.BLOCK, 5000) == ids[id_coder.BLOCK: 2 * id_coder.BLOCK]).all()
    broken = bytearray(payload[0])
    broken[40] ^= 255
    with pytest.raises(ValueError):
        id_coder.decode([bytes(broken), *payload[1:]], crcs, 9000, 5000)


@pytest.mark.parametrize("alphabet", [1, 3, 50257, id_coder.MAX_ALPHABET])
def test_coder_alphabets(alphabet):
    for n in (1, 17, id_coder.BLOCK + 1, 9000):
        ids = np.random.default_rng(n).integers(0, alphabet, n)
        assert (id_coder.decode(*id_coder.encode(ids, alphabet), n, alphabet) == ids).all()
    with pytest.raises(ValueError):
        id_coder.encode(np.zeros(1, int), id_coder.MAX_ALPHABET + 1)


def test_piece_ids_are_those_of_whole_texts():
    e = token_output.PieceEncoder(TOKENIZER)
    texts = ["\na", "a\n", "a\nb c", "a \nb c", "a\n\nb c", " \nb", "a\r\nb", "日\nb a", "  a  b", " a", "a ", "a \u3000x", "x\u00a0 y",
             "<|endoftext|> a <|endoftext|>", "", " ", "é  ü", "a's\n's b"]
    assert [x.tolist() for x in e.ids(texts)] == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def expected_ids(rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    return [(i, [*e.ids, 0]) for (i, _), e in zip(rows, t.encode_batch([x or "" for _, x in rows], add_special_tokens=False))]


def test_token_output(spark, docs, odd, none):
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()))
    start, want = 0, {}
    for i, ids in expected_ids(rows):
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.QUERIES["op2_token_output"](spark, SF).collect()}
    assert got == want
    o = token_output.token_digest(odd, TOKENIZER).orderBy("start").collect()
    assert len(o) == len(ROWS) and [r.doc_id is None for r in o[:2]] == [True, True]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in o) == Counter(
        (i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in expected_ids([r[:2] for r in ROWS]))
    assert [r.start for r in o] == np.cumsum([0, *[r.n_tokens for r in o[:-1]]]).tolist()
    assert token_output.token_digest(none, TOKENIZER).count() == 0


# 3 language model

def test_language_model(spark, docs, odd, none):
    got = {r.doc_id: r for r in queries.QUERIES["op3_bloom_lm"](spark, SF).collect()}
    tok = {r.doc_id: [*words(r.text), "\0"] for r in docs.collect()}
    train = Counter(w for i, t in tok.items() if zlib.crc32(str(i).encode()) % 10 for w in t)
    n, v = sum(train.values()), len(train)
    for i, t in tok.items():
        r = got[i]
        base = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(train[w] > 0 for w in t), n)
        assert abs(r.base_score - base) <= 1e-9 * abs(base) and r.score < 0
        assert r.held_out == (zlib.crc32(str(i).encode()) % 10 == 0)
    # The model by plain dictionaries: pair counts as one filter's probes give them, over their sum for the word
    # before and the count that absent pairs are expected to get.
    pairs = Counter()
    for i, t in tok.items():
        if zlib.crc32(str(i).encode()) % 10:
            pairs.update(zip(["\0", *t[:-1]], t))
    model = bloom_lm.build(docs.where(common.fold(10) != 0))
    (_, block), = bloom_lm.read_blocks(model, [0])
    seen = sorted(pairs)
    assert model.blocks == 1
    first, second = ([bloom_lm.END if w == "\0" else bloom_lm.token_hashes([w])[0][0] for w in x] for x in zip(*seen))
    level = block.level(bloom_lm.mix64(np.array(first, np.uint64) * bloom_lm._PAIR + np.array(second, np.uint64)))
    true = bloom_lm.levels(np.array([pairs[x] for x in seen]))
    assert (level >= true).all() and (level == true).mean() > 0.95
    found = dict(zip(seen, bloom_lm.dequantised(level).tolist()))
    mass, follow = Counter(), Counter()
    for (a, _), c in found.items():
        mass[a] += c
        follow[a] += 1
    chance, smooth = model.absent / v, lambda w: bloom_lm.MU * (train[w] + 0.1) / (n + 0.1 * (v + 1))
    assert 0 < model.absent < 0.05 * bloom_lm.MU
    off = 0
    for i, t in tok.items():
        want = sum(math.log10((found.get((a, w), 0) + smooth(w)) / (mass[a] + chance * (v - follow[a]) + bloom_lm.MU)) for a, w in zip(["\0", *t[:-1]], t))
        off += abs(got[i].score - want) > 1e-5 * abs(want)
    assert off <= 2  # texts with a pair that passes by chance
    assert sum(r.score for r in got.values()) > sum(r.base_score for r in got.values())
    o = bloom_lm.score_texts(odd, odd, ["doc_id", "score"]).collect()
    assert len(o) == len(ROWS) and {r.n_tokens for r in o if r.doc_id in (2, 3, 5)} == {1}
    assert bloom_lm.score_texts(none, none, ["doc_id"]).count() == 0
    assert {r.score for r in bloom_lm.score_texts(odd, none, ["doc_id"]).collect()} == {0.0}


def test_language_model_shards_agree(spark, docs, monkeypatch):
    monkeypatch.setattr(bloom_lm, "BLOCK_BYTES", 1 << 16)
    one = {r.doc_id: (r.base_score, r.score) for r in bloom_lm.score_texts(docs, docs, ["doc_id"]).collect()}
    monkeypatch.setattr(bloom_lm, "SHARD_BYTES", 1 << 18)
    many = {r.doc_id: (r.base_score, r.score) for r in bloom_lm.score_texts(docs, docs, ["doc_id"]).collect()}
    assert all(np.allclose(one[i], many[i], rtol=1e-9) for i in one) and one.keys() == many.keys()
    # Few n-grams in much text: most blocks hold none.
    flat = spark.createDataFrame([(1, "a " * 400_000), (2, "b")], "doc_id long, text string")
    got = {r.doc_id: r for r in bloom_lm.score_texts(flat, flat, ["doc_id"]).collect()}
    n = 400_003
    assert abs(got[2].base_score - math.log10(1.1 / (n + 0.4)) - math.log10(2.1 / (n + 0.4))) < 1e-9 and got[2].score < 0


def test_language_model_adds_up_to_one(spark, docs, monkeypatch):
    monkeypatch.setattr(bloom_lm, "BLOCK_BYTES", 1 << 16)
    model = bloom_lm.build(docs)
    v, total = model.words, model.tokens + 0.1 * (model.words + 1)
    held = dict(bloom_lm.read_blocks(model, list(range(model.blocks))))
    assert len(held) == model.blocks > 1 and sum(len(b.words) for b in held.values()) == v and 0 < len(model.hot) <= bloom_lm.HOT
    known = np.concatenate([b.words for b in held.values()])
    count, mass = (np.concatenate(x) for x in zip(*[b.count(b.words) for b in held.values()]))
    assert dict(zip(known.tolist(), count.tolist())).items() >= dict(zip(model.hot.tolist(), model.hot_counts.tolist())).items()
    for first in [*np.argsort(-count)[:20], *np.flatnonzero(count == 1)[:20], *np.flatnonzero(count == 9)[:20]]:
        h = bloom_lm.mix64(known[[first]] * bloom_lm._PAIR + known)
        level, place = np.zeros(v, np.uint8), bloom_lm.pair_blocks(h, known, model.hot, model.blocks)
        for k, b in held.items():
            level[place == k] = b.level(h[place == k])
        p = bloom_lm.dequantised(level) + bloom_lm.MU * (count + 0.1) / total
        unknown = bloom_lm.MU * 0.1 / total
        assert abs((p.sum() + unknown) / (mass[first] + bloom_lm.MU) - 1) < 0.06  # a chance positive or two, next to MU


def test_filter_has_no_false_negatives():
    r = np.random.default_rng(1)
    h, c = r.integers(0, 1 << 63, 5000).astype(np.uint64), r.zipf(1.5, 5000).clip(1, 10**6)
    bits, chance = bloom_lm.filter_bits(h, bloom_lm.levels(c), 14)
    block = bloom_lm.Block(b"", b"", b"", bits.tobytes(), 14)
    assert (block.level(h) >= bloom_lm.levels(c)).all() and (block.level(h) == bloom_lm.levels(c)).mean() > 0.9
    absent = block.level(r.integers(0, 1 << 63, 1_000_000).astype(np.uint64))
    assert 0 < bloom_lm.dequantised(absent).mean() < 2 * chance < 4e-4


# 4 top-k

def test_voronoi_many_blocks_and_edges(spark, monkeypatch):
    monkeypatch.setattr(voronoi_knn, "BLOCK_ROWS", 16)
    monkeypatch.setattr(voronoi_knn, "QUERY_ROWS", 4)
    r = np.random.default_rng(2)
    x = [[float(c) for c in r.normal(size=4)] for _ in range(150)] + [[0.5, 0.5, 0.0, 1.0]] * 60
    rows = [(i, v) for i, v in enumerate(x)] + [(500, None), (501, [1.0, None, 2.0, 3.0]), (502, [float("nan")] * 4), (503, [float("inf"), 0.0, 0.0, 0.0]),
                                                (None, [1.0] * 4), (10, x[10])]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = voronoi_knn.top_k(voronoi_knn.quantised(e), 7, F.col("vec_id") % 5 == 0).collect()
    q = {i: [math.floor(64 * c) for c in v] for i, v in enumerate(x)}
    for i in range(0, len(x), 5):
        s = sorted(((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in q if j != i))[:7]
        assert [(r.rank, r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == i), key=lambda r: r.rank)] == [
            (k + 1, j, -t) for k, (t, j) in enumerate(s)]
    assert len(got) == 7 * len(range(0, len(x), 5))
    assert voronoi_knn.top_k(voronoi_knn.quantised(e.limit(0)), 7, F.lit(True)).count() == 0


def test_voronoi_small_clustered_table(spark):
    assert [voronoi_knn.group_count(n) for n in (1, 5, 500, 16_385, 10**9)] == [1, 5, 8, 9, 1024]
    r = np.random.default_rng(4)
    centres = r.normal(size=(6, 8)) * 20
    x = np.concatenate([c + r.normal(size=(50, 8)) * 0.3 for c in centres])
    e = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    q = np.floor(64 * x).astype(np.int64)
    s = q @ q.T
    np.fill_diagonal(s, -10**15)
    got = voronoi_knn.top_k(voronoi_knn.quantised(e), 5, F.col("vec_id") % 10 == 0).collect()
    assert {(o.query_id, o.rank, o.vec_id, o.score) for o in got} == {
        (i, k + 1, int(j), int(s[i, j])) for i in range(0, len(x), 10) for k, j in enumerate(np.lexsort((np.arange(len(x)), -s[i]))[:5])}


# 5 mixing

def test_mix_budgets_and_edges(odd, none, docs):
    for d in (odd, docs):
        m = source_mix.mix_sources(d, rows_per_range=2).collect()
        assert len(m) == d.count()
        taken, target = Counter(), {}
        for r in m:
            assert 0 <= r.taken <= 2 * r.size and r.taken == r.epochs * r.size + r.part
            taken[r.source] += r.taken
            target[r.source] = r.target
        assert all(abs(taken[s] - target[s]) <= 1 for s in target)
        assert abs(sum(target.values()) - 1.5 * sum(r.size for r in m)) < 1e-6 * sum(r.size for r in m) + 1
    assert source_mix.mix_sources(none).count() == 0
    rows = source_mix.mixed_rows(source_mix.mix_sources(odd), ["source", "text"])
    got = Counter()
    for r in rows.collect():
        got[r.source] += len(words(r.text))
    assert all(abs(got[s] - t) <= 1 for s, t in {r.source: r.target for r in source_mix.mix_sources(odd).collect()}.items())


def test_documents_without_words_are_repeated_too(odd):
    mixed = source_mix.mix_sources(odd)
    want = Counter({(r.doc_id, r.source): r.epochs for r in mixed.where("size = 0").collect()})
    got = Counter((r.doc_id, r.source) for r in source_mix.mixed_rows(mixed.where("size = 0"), ["doc_id", "source"]).collect())
    assert got == +want and sum(got.values()) > 0


# 6 toxicity

def test_toxicity_held_out_and_edges(spark, odd, none):
    sf = "/root/testdata/sf0.01"
    r = {x.doc_id: x for x in queries.QUERIES["op6_toxicity"](spark, sf).collect()}
    labels = {x.doc_id: x.toxic for x in common.table(spark, sf, "labels").collect()}
    held = [i for i in labels if r[i].held_out]
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in r.values())
    hit = sum(r[i].predicted == labels[i] for i in held) / len(held)
    assert hit > 0.85 and np.mean([r[i].score for i in held if labels[i]]) > 3 * np.mean([r[i].score for i in held if not labels[i]])
    lab = spark.createDataFrame([(1, 1, None), (4, 1, 0), (4, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    o = toxicity.toxicity(odd, lab, odd.columns)
    assert o.count() == len(ROWS) and o.columns == [c for c in odd.columns if c != "score"] + ["score"]
    assert toxicity.toxicity(none, lab.limit(0), ["doc_id"]).count() == 0


def test_toxicity_rare_labels(spark, tmp_path):
    d = [(i, f"you zorbing blotter number {i}" if i % 100 == 0 else f"a plain text of words and number {i}") for i in range(1, 4001)]
    docs = spark.createDataFrame(d, "doc_id long, text string")
    lab = spark.createDataFrame([(i, 1, int(i % 100 == 0)) for i, _ in d], "doc_id long, quality int, toxic int")
    kept = toxicity._sample(lab, 160).collect()
    assert len(kept) <= 160 and sum(r.y for r in kept) == 20
    assert all({r.part for r in kept if r.y == y} == set(range(8)) for y in (0, 1))
    n = {r.y: r["count"] for r in lab.where(common.fold(4) != 2).groupBy(F.col("toxic").alias("y")).count().collect()}
    share = {y: sum(r.w for r in kept if r.y == y) for y in (0, 1)}
    assert abs(share[1] / sum(share.values()) - n[1] / sum(n.values())) < 1e-9
    got = {r.doc_id for r in toxicity.fit(docs, lab, 160).score(docs, ["doc_id"]).where("score >= 0.3").collect()}
    assert got == set(range(100, 4001, 100))
    for k, y in enumerate((1, None)):  # one label only, no usable label
        sf = str(tmp_path / str(k))
        spark.createDataFrame([(i, 1, y) for i in range(1, 9)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        assert corpus_pipeline.drop_toxic(spark, docs, sf).count() == 4000


def test_toxicity_features():
    f = toxicity.Features({"zorb$": 3.0, "blee": 2.5})
    x = f.matrix([None, "", "you ZORB! bleeping x", "z0rb plain", "clean words here"])
    at = {n: i for i, n in enumerate(toxicity.NAMES)}
    assert not x[:2].any() and x[2, at["hits"]] == 0.5 and x[2, at["near"]] == 1 and x[3, at["hidden"]] == 0.5 and x[4, at["hits"]] == 0


# 7 token counts

def test_token_counts(spark, docs, odd, none):
    extra = ["a  b \n c", "  x ' s 's", " <|endoftext|> a<|endoftext|>b  ", "日本 語 x  ", "\n \n x 'll you'll'sabc 'S", "ab1" * 3000, " " * 3000, "'" * 700 + "s"]
    texts = [*extra, *[r.text for r in docs.collect()], *[r[1] for r in ROWS]]
    want = [len(x) - 1 for _, x in expected_ids([(0, t) for t in texts])]
    assert token_counts.Counter(TOKENIZER).count(texts) == want
    o = token_counts.count_tokens(odd, TOKENIZER)
    assert Counter((r.n_bytes, r.n_tokens) for r in o.collect()) == Counter((len((r[1] or "").encode()), n) for r, n in zip(ROWS, want[-len(ROWS):]))
    assert token_counts.count_tokens(none, TOKENIZER).count() == 0


# 8 language

def test_marginals_against_plain_forward_backward():
    r = np.random.default_rng(0)
    k, n = 3, 700
    e, begin = r.random((n, k)) + 0.01, np.zeros(n, bool)
    begin[[0, 5, 6, 300, 511, 512]] = True
    first, move = r.random(k), r.random((k, k))
    out, cuts = np.zeros((n, k)), [*np.flatnonzero(begin), n]
    for a, b in zip(cuts, cuts[1:]):
        alpha = [first * e[a]]
        for t in range(a + 1, b):
            alpha.append(alpha[-1] @ move * e[t])
            alpha[-1] /= alpha[-1].sum()
        beta = np.ones(k)
        for t in range(b - 1, a - 1, -1):
            out[t] = alpha[t - a] * beta / (alpha[t - a] * beta).sum()
            beta = move @ (e[t] * beta)
            beta /= beta.sum()
    assert np.abs(out - crf_language.marginals(e, begin, first, move)).max() < 1e-12


def test_language_held_out_and_edges(spark, docs, odd, none):
    r = {x.doc_id: x for x in queries.QUERIES["op8_crf_language"](spark, SF).collect()}
    lang = {x.doc_id: x.lang for x in docs.collect()}
    held = [i for i in r if r[i].held_out and lang[i]]
    assert np.mean([r[i].lang_pred == lang[i] for i in held]) > 0.95
    o = {x.doc_id: x for x in crf_language.languages(odd, ["doc_id", "score"]).collect()}
    assert {o[i].lang_pred for i in (2, 3, 5, 10)} == {"und"} and o[6].lang_pred == "en"
    assert crf_language.languages(none, ["doc_id"]).count() == 0


# 9 decontamination

def test_templates(spark):
    bench = spark.createDataFrame([(1, "A train moves 60 km in 2 hours and then another 60 km, how far did it go today?"),
                                   (2, "tiny item of five"), (3, None), (4, "")], "item_id long, text string")
    d = [(1, "Now. a train moves 75 km in 3 hours and then another 75 km, how far did it go today? ok"),
         (2, "Now. a train moves 75 km in 3 hours and then another 80 km, how far did it go today? ok"),
         (3, "a train moves 60 km in 2 hours and then another 60 km, how far did it go today?"), (4, "tiny item of five"), (5, "a clean text about nothing much at all in here"),
         (6, None), (None, "a train moves 60 km in 2 hours and then another 60 km, how far did it go today?"),
         (None, "another clean text of no number and no row")]
    docs = spark.createDataFrame(d, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.reparameterised for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {(1, 1): True, (3, 1): False, (4, 2): False, (None, 1): False}
    assert {(r.doc_id, (r.text or "")[:7]) for r in decontaminate.without_benchmark(docs, bench).collect()} == {(2, "Now. a "), (5, "a clean"), (6, ""), (None, "another")}
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0 and decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_planted_passages_are_found(spark, docs):
    """Every document holding twelve words of an item in a row is reported, and no other."""
    low = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = {tuple(w[i:i + 12]) for r in common.table(spark, SF, "benchmark").collect() for w in [low(r.text)] for i in range(len(w) - 11)}
    want = {r.doc_id for r in docs.collect() if any(tuple(low(r.text)[i:i + 12]) in grams for i in range(len(low(r.text)) - 11))}
    got = {r.doc_id for r in queries.QUERIES["op9_decontaminate"](spark, SF).collect()}
    assert want <= got and len(got - want) <= 1


def test_capital_copies_are_found(spark):
    """Every item of sf0.1 copied in capitals or title case, and with other numbers."""
    bench = common.table(spark, "/root/testdata/sf0.1", "benchmark")
    items = [(r.item_id, r.text) for r in bench.collect()]
    other = lambda t: re.sub(r"\d+", lambda m: str(int(m[0]) + 1000), t)
    docs = [(10 * i + k, "Some words before. " + f(t) + " and after") for i, t in items
            for k, f in enumerate((str.upper, str.title, lambda t: other(t).upper()))]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert not {(d, d // 10) for d, _ in docs} - got
    real = {r.doc_id for r in queries.QUERIES["op9_decontaminate"](spark, "/root/testdata/sf0.1").collect()}
    assert {1699, 6420, 8376} <= real


def test_literal_copies_with_many_placeholders(spark):
    items = [(1, "12 34 56 78 90 12 34 56 78 90 11"), (2, "ask Ann Bob Cid Dan Eve Fay Gus Hal Ida"), (3, "add 5 6 7 8"), (4, "9 10")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(10 * i, f"so {t} then") for i, t in items] + [(10 * i + 1, t.upper()) for i, t in items]
    docs += [(5, "so 12 34 56 78 90 13 35 57 79 91 11 then"), (6, "then add 5 6 7 9 now"), (7, "ask Ida Hal Gus Fay Eve Dan Cid Bob Ann")]
    got = {(r.doc_id, r.item_id, r.reparameterised) for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == {(10, 1, False), (11, 1, False), (20, 2, False), (21, 2, False), (30, 3, False), (31, 3, False), (41, 4, False)}


def test_a_changed_slot_does_not_veto_equal_windows(spark):
    w = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(80)]
    text = lambda a, b: " ".join([*w[:20], str(a), *w[20:60], str(b), *w[60:]])
    near = lambda a, b: " ".join([*w[:6], str(a), *w[6:10], str(b), *w[10:16]])
    bench = spark.createDataFrame([(1, text(60, 60)), (2, text(60, 70).replace("w", "v")), (3, near(60, 60).replace("w", "u"))], "item_id long, text string")
    docs = [(1, text(60, 80)), (2, text(65, 65).replace("w", "v")), (3, near(61, 62).replace("w", "u")),
            (None, near(63, 63).replace("w", "u")), (None, near(64, 64).replace("w", "u")), (9, near(63, 63).replace("w", "u")), (9, near(63, 64).replace("w", "u"))]
    got = {(r.doc_id, r.item_id): r.n_windows for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got.keys() == {(1, 1), (2, 2), (3, 3), (None, 3), (9, 3)} - {(3, 3)} and got[1, 1] == 75 and got[2, 2] == 75


# 10 near duplicates

def brute(rows):
    sets = [frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset() for w in (words(t) for _, t in rows)]
    at = list(range(len(rows)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                at[root(i)] = root(j)
    return sets, [root(i) for i in range(len(rows))]


def test_near_duplicates_chains_and_edges(spark, odd, none, monkeypatch):
    monkeypatch.setattr(hyperminhash, "BLOCK_MEMBERS", 8)
    r = np.random.default_rng(4)
    base = [f"v{i}" for i in r.integers(0, 5000, 120)]
    rows = []
    for i in range(60):  # a family in which many pairs are just above or below the threshold
        w = list(base)
        for j in r.integers(0, 120, int(r.integers(0, 6))):
            w[j] = f"n{r.integers(0, 30)}"
        rows.append((100 + i, " ".join(w)))
    rows += [(i, t) for i, t, *_ in ROWS if i is not None]
    sets, root = brute(rows)
    least = {c: min(rows[i][0] for i in range(len(rows)) if root[i] == c) for c in root}
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in hyperminhash.near_duplicates(d).collect())
    assert got == Counter((rows[i][0], len(sets[i]), least[root[i]], rows[i][0] == least[root[i]]) for i in range(len(rows)))
    kept = hyperminhash.one_per_group(odd)
    assert kept.columns == odd.columns
    ids = Counter(x.doc_id for x in kept.collect())
    assert ids == Counter({1: 1, 2: 1, 3: 1, None: 2, 5: 1, 6: 1, 8: 1, 9: 1, 10: 1, 11: 2})
    assert hyperminhash.near_duplicates(none).count() == 0


def test_estimate_is_close():
    r = np.random.default_rng(5)
    x = r.integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2)
    for n in (1000, 1500, 1900):
        a, b = np.unique(x[:2000]), np.unique(np.concatenate([x[:n], x[2000:4000 - n]]))
        reg = hyperminhash.short_registers(hyperminhash.registers([a, b]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        est = hyperminhash.estimated_jaccard(reg[:1], reg[1:], np.array([len(a)]), np.array([len(b)]))[0]
        assert abs(est - true) < 0.15


# pipeline

def test_pipeline_stages(spark, odd, none, tmp_path):
    sf = str(tmp_path)
    odd.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, "nothing of this item stands in any of the texts")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    d = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, sf)
        assert d.columns == odd.columns, name
        assert stage(spark, none, sf).columns == odd.columns
    assert set(r["size"] for r in d.collect()) == {5}
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0


def test_pipeline_drops_what_it_should(spark):
    sf = "/root/testdata/sf0.01"
    docs = common.table(spark, sf, "documents")
    clean = corpus_pipeline.drop_benchmark(spark, docs, sf)
    hit = {r.doc_id for r in queries.QUERIES["op9_decontaminate"](spark, sf).collect()}
    assert {r.doc_id for r in clean.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()} - hit
