"""What helpers of the training-data operators hold at once."""

import tracemalloc

import numpy as np

from wardflow.llm import common, hyperminhash


def _peak(run) -> int:
    run()  # tables that are kept
    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak


def test_words_are_hashed_in_small_runs():
    texts = [b"some words, and some more of them " * 60] * 1000  # 2 MB
    assert _peak(lambda: common.word_hashes(texts)) < 30 << 20
    h, at = common.word_hashes(texts)
    one, _ = common.word_hashes(texts[:1])
    assert np.array_equal(h, np.tile(one, 1000)) and at.tolist() == [k * len(one) for k in range(1001)]
    long = b"x " + b"long words " * 60_000  # longer than a run
    h, at = common.word_hashes([b"", long, b"x"])
    assert at.tolist() == [0, 0, 120_001, 120_002] and h[0] == h[-1]
    assert sum(map(len, common._POW.values())) < 1 << 20


def test_registers_are_built_for_a_small_part_of_a_batch():
    import pyarrow as pa
    n = 1000
    batch = pa.record_batch([pa.array(range(n)), pa.array([f"w{k} some words and some more of them " * 55 for k in range(n)]), pa.array([0] * n)], names=["doc_id", "text", "h"])
    assert _peak(lambda: [x.num_rows for x in hyperminhash._features(5)([batch])]) < 25 << 20


def test_places_in_order_of_hashes():
    from wardflow.llm import bloom_lm
    r = np.random.default_rng(3)
    spread = r.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)
    for h in (spread, r.choice(spread[:50], 5000), np.arange(5000, dtype=np.uint64)[::-1], spread[:1], spread[:0]):  # the third differs in its lowest bits only
        assert np.array_equal(bloom_lm._order(h), np.argsort(h, kind="stable"))
    at = r.integers(0, 70, 3000)
    by, ends = bloom_lm._by_block(at, 70)
    assert np.array_equal(by, np.argsort(at, kind="stable")) and ends.tolist() == [int((at < k).sum()) for k in range(71)]


def test_levels_are_those_of_probes_one_by_one():
    from wardflow.llm import bloom_lm
    r = np.random.default_rng(4)
    pairs = r.integers(0, 1 << 63, 3000, dtype=np.uint64)
    bits, _ = bloom_lm.filter_bits(pairs, r.integers(1, 5, 3000), 18)
    on, block = np.unpackbits(bits), bloom_lm.Block(b"", b"", b"", bits.tobytes(), 18)

    def plain(h):
        level = 0
        while True:
            x, step = bloom_lm._probes(np.array([h]), level + 1)
            for k in range(bloom_lm.PROBES if level else 18):
                if not on[bloom_lm._place(x + step * np.uint64(k), np.uint64(len(on)))[0]]:
                    return level
            level += 1

    asked = np.concatenate([pairs[:200], r.integers(0, 1 << 63, 200, dtype=np.uint64)])
    assert block.level(asked).tolist() == [plain(h) for h in asked]


def test_token_frames_take_texts_in_small_runs(monkeypatch):
    from types import SimpleNamespace

    import pyarrow as pa
    from wardflow.llm import token_output
    seen = []
    fake = SimpleNamespace(alphabet=300, forget=lambda: None, ids=lambda texts: seen.append(sum(map(len, texts))) or [np.arange(3, dtype=np.uint32)] * len(texts))
    monkeypatch.setattr(token_output, "encoder", lambda path: fake)
    monkeypatch.setattr(token_output, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    batch = pa.record_batch([pa.array(range(2000)), pa.array(["some text " * 50] * 2000)], names=["doc_id", "text"])  # 1 MB
    row, = token_output._frames("")([batch])
    assert max(seen) <= common.HASH_BYTES and row.column(2)[0].as_py() == 8000 and row.column(4)[0].as_py() == [4] * 2000


def test_the_coder_holds_few_copies_of_a_frame():
    from wardflow.llm import id_coder
    ids = np.random.default_rng(1).zipf(1.3, 64 * id_coder.BLOCK).clip(0, 49_999).astype(np.uint32)
    assert _peak(lambda: id_coder.encode(ids, 50_000)) < 36 * len(ids)
