"""Near-duplicate documents by HyperMinHash.

A document's shingle hashes fall into 256 buckets. Each bucket keeps only the
smallest hash, compressed to its leading-zero count and the 8 bits after the
leading one. Empty buckets borrow from others in a fixed order. Five registers
make a band; documents that agree in a whole band are candidates. Candidates
pass an estimate of their Jaccard similarity, corrected for registers that
agree by chance, and are confirmed on their full shingle sets. Before that,
shingles that only one candidate has are counted: they bound every
intersection from above, which drops rewritten copies without comparing them.

Documents with equal shingle sets form one class first, and everything after
works on classes. Band buckets are split by size classes one threshold wide
(each member is in its own and the next one). First the members of a bucket
meet only its pivots (the members of the highest random level); that connects
most buckets. Buckets that still hold several components are cut into blocks of
bounded size, and pairs of blocks are compared as matrices of fingerprints, so
that all members in different components are compared without a row per pair.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import encoded, mix64, slices, table, trimmed, word_hashes
from wardflow.llm.components import components
from wardflow.session import materialize

WORDS = 5
LINK = (75, 100)      # link when 100 * intersection >= 75 * union
BUCKET_BITS = 8
BUCKETS = 1 << BUCKET_BITS
ROWS = 5              # registers in a band: 51 bands; a pair at 0.75 misses all with chance 0.763 ** 51 = 1e-6
BANDS = BUCKETS // ROWS
MANTISSA = 8
ESTIMATE_FROM = 48    # smaller sets go straight to their full sets

SLICE_BYTES = 256 << 10   # text whose sets and registers are held at once
BLOCK_MEMBERS = 256   # members of an open bucket compared at once

_MULT = mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (its whole word sequence if shorter)."""
    h, at = word_hashes(texts)
    n = max(0, len(h) - words + 1)
    s = np.zeros(n, np.uint64)
    for j in range(words):
        s += h[j: j + n] * _MULT[j]
    s = mix64(s)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(s[a: b - words + 1]))
        elif b > a:
            out.append(mix64((h[a:b] * _MULT[: b - a]).sum(keepdims=True) + _MULT[20 + b - a]))
        else:
            out.append(h[:0])
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers (one row of 256 per non-empty set)."""
    x = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    bucket = (x >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    slot = row * BUCKETS + bucket
    first = np.flatnonzero(np.diff(slot, prepend=-1))  # sets are sorted: the first of a bucket is its smallest
    rest = (x[first] << np.uint64(BUCKET_BITS)) | np.uint64(1)
    zeros = (64 - np.frexp(rest.astype(np.float64))[1]).clip(0)
    mantissa = (rest << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
    reg = np.full(len(sets) * BUCKETS, -1, np.int32)
    reg[slot[first]] = (zeros << MANTISSA) + mantissa.astype(np.int64)
    reg = reg.reshape(-1, BUCKETS)
    # Empty buckets try the others in an order fixed by (bucket, attempt).
    out, attempt = reg.copy(), 0
    todo = np.flatnonzero((out < 0).any(1))
    while len(todo):
        attempt += 1
        pick = (mix64(np.arange(BUCKETS, dtype=np.uint64) * np.uint64(65537) + np.uint64(attempt)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        part = out[todo]
        out[todo] = np.where(part < 0, reg[todo][:, pick], part)
        todo = todo[(out[todo] < 0).any(1)]
    return out.astype(np.uint16)


def band_keys(reg: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of registers."""
    r = reg[:, : BANDS * ROWS].reshape(len(reg), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(mix64(np.arange(1, BANDS + 1, dtype=np.uint64)), r.shape[:2])
    for j in range(ROWS):
        key = mix64(key + r[:, :, j] * _MULT[j])
    return key.view(np.int64)


def _chance_table() -> np.ndarray:
    """Chance that two registers of unrelated sets agree; rows and columns:
    log2 of the hashes per bucket, 0 to 24."""
    i = np.arange(1, 57)[:, None]
    j = np.arange(1 << MANTISSA)[None]
    low = ((1 << MANTISSA) + j) / 2.0 ** (MANTISSA + i)
    high = ((1 << MANTISSA) + j + 1) / 2.0 ** (MANTISSA + i)
    n = 2.0 ** np.arange(25)
    p = np.stack([((1 - low) ** k - (1 - np.minimum(high, 1)) ** k).ravel() for k in n])
    return p @ p.T


_CHANCE: list[np.ndarray] = []


def short_registers(reg: np.ndarray) -> np.ndarray:
    """One byte per register, for estimates."""
    return (reg.astype(np.uint32) * np.uint32(40503) >> np.uint32(8)).astype(np.uint8)


def fingerprints(s: np.ndarray) -> np.ndarray:
    """Sorted 16-bit values of a set's shingles, repeats kept. Equal shingles
    have equal values, so counting meetings never undercounts."""
    return np.sort((s >> np.uint64(24)).astype(np.uint16))


def meetings(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the multiset intersection of two sorted arrays."""
    v, k = np.unique(x, return_counts=True)
    w, l = np.unique(y, return_counts=True)
    _, i, j = np.intersect1d(v, w, assume_unique=True, return_indices=True)
    return int(np.minimum(k[i], l[j]).sum())


def estimated_jaccard(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Share of equal registers, corrected for chance agreement."""
    if not _CHANCE:
        _CHANCE.append(_chance_table())
    level = lambda n: np.clip(np.rint(np.log2(np.maximum(n / BUCKETS, 1))), 0, 24).astype(int)
    e = _CHANCE[0][level(n_a), level(n_b)]
    e = e + (1 - e) / 256  # registers are compared as one byte each
    return ((a == b).mean(1) - e) / (1 - e)


def _features(words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("set_key", pa.binary()), ("n_shingles", pa.int64()), ("regs", pa.binary())])

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for i, j, texts in slices(batch.column(1), SLICE_BYTES):
                sets = shingle_sets(encoded(texts), words)
                full = [s for s in sets if len(s) > 2]  # smaller sets link only when equal
                regs = iter(registers(full)) if full else iter(())
                yield pa.record_batch([
                    ids.slice(i, j - i).cast(pa.int64()), batch.column(2).slice(i, j - i),
                    pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([next(regs).tobytes() if len(s) > 2 else None for s in sets], pa.binary())], schema=schema)
    return run


def _sets(words: int):
    """Full sets of the texts, again, for those that became candidates."""
    schema = pa.schema([("set_key", pa.binary()), ("shingles", pa.binary()), ("f", pa.binary())])

    def run(batches):
        for batch in batches:
            for _, _, texts in slices(batch.column(0), SLICE_BYTES):
                sets = shingle_sets(encoded(texts), words)
                yield pa.record_batch([pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], pa.binary()),
                                       pa.array([s.tobytes() for s in sets], pa.binary()),
                                       pa.array([fingerprints(s).tobytes() for s in sets], pa.binary())], schema=schema)
    return run


def _plausible(batches):
    """Pairs whose estimate is less than five standard deviations under the
    threshold (of as many registers as the smaller set fills) and whose 16-bit
    fingerprints meet often enough (an upper bound of the intersection)."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("lvl", pa.int32())])
    for batch in batches:
        if not batch.num_rows:
            continue
        n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
        r = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BUCKETS) for c in ("r_a", "r_b")]
        least = np.minimum(n_a, n_b)
        j = LINK[0] / LINK[1]
        floor = j - 5 * np.sqrt(j * (1 - j) / (BUCKETS * -np.expm1(-least / BUCKETS)))
        ok = (least < ESTIMATE_FROM) | (estimated_jaccard(*r, n_a, n_b) >= floor)
        f_a, f_b = batch.column("f_a"), batch.column("f_b")
        for i in np.flatnonzero(ok):
            both = meetings(np.frombuffer(f_a[i].as_py(), np.uint16), np.frombuffer(f_b[i].as_py(), np.uint16))
            ok[i] = LINK[1] * both >= LINK[0] * (n_a[i] + n_b[i] - both)
        yield pa.record_batch([batch.column("a"), batch.column("b"), batch.column("lvl")], schema=schema).filter(pa.array(ok))


def _prints(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all rows with the row they belong to; the i-th repeat of
    a value within a row is a value of its own."""
    f = [np.frombuffer(r["f"], np.uint16).astype(np.int64) for r in rows]
    owner = np.repeat(np.arange(len(f)), [len(x) for x in f])
    x = np.concatenate(f)
    new = np.concatenate([[True], (x[1:] != x[:-1]) | (owner[1:] != owner[:-1])])
    at = np.arange(len(x))
    return (at - np.maximum.accumulate(np.where(new, at, 0))) * 65536 + x, owner


def _block_pairs(batches):
    """Pairs of two blocks of one bucket, in different components, that can
    still link by sizes, shared shingles and fingerprints."""
    for batch in batches:
        for i in range(batch.num_rows):
            a, b = batch.column("rows_a")[i].as_py(), batch.column("rows_b")[i].as_py()
            get = lambda rows, c: np.array([r[c] for r in rows])
            n_a, n_b, m_a, m_b = get(a, "n")[:, None], get(b, "n")[None], get(a, "m")[:, None], get(b, "m")[None]
            number = {c: k for k, c in enumerate({r["comp"] for r in a + b})}
            can = lambda both: LINK[1] * both >= LINK[0] * (n_a + n_b - both)
            ok = can(np.minimum(m_a, m_b)) & (np.array([number[r["comp"]] for r in a])[:, None] != np.array([number[r["comp"]] for r in b])[None])
            if batch.column("part")[i] == batch.column("other")[i]:
                ok &= np.triu(np.ones(ok.shape, bool), 1)
            if not ok.any():
                continue
            (x, own_x), (y, own_y) = _prints(a), _prints(b)
            values = np.intersect1d(x, y)
            both = np.zeros(ok.shape, np.float32)
            for k in range(0, len(values), 4096):  # columns of the two 0/1 matrices
                part = values[k: k + 4096]
                sides = []
                for v, own, rows in ((x, own_x, a), (y, own_y, b)):
                    at = np.minimum(np.searchsorted(part, v), len(part) - 1)
                    hit = part[at] == v
                    m = np.zeros((len(rows), len(part)), np.float32)
                    m[own[hit], at[hit]] = 1
                    sides.append(m)
                both += sides[0] @ sides[1].T
            p, q = np.nonzero(ok & can(np.rint(both).astype(np.int64)))
            if len(p):
                yield pa.record_batch([pa.array([a[j]["set_key"] for j in p], pa.binary()), pa.array([b[j]["set_key"] for j in q], pa.binary())], names=["a", "b"])


def _shingle_rows(batches):
    """(shingle, hi, lo): a row per shingle; hi and lo are the halves of the class key."""
    for batch in batches:
        for key, s in zip(batch.column(0), batch.column(1)):
            s = np.frombuffer(s.as_py(), np.int64)
            hi, lo = np.frombuffer(key.as_py(), np.int64)
            yield pa.record_batch([pa.array(s), pa.array(np.full(len(s), hi)), pa.array(np.full(len(s), lo))], names=["shingle", "hi", "lo"])


def _halves(batches):
    for batch in batches:
        k = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64).reshape(-1, 2)
        reg = short_registers(np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(-1, BUCKETS))
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in reg], pa.binary()), batch.column(3),
                               pa.array(k[:, 0].copy()), pa.array(k[:, 1].copy())], names=["set_key", "n", "r", "f", "hi", "lo"])


def _confirmed(batches):
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    for batch in batches:
        ok = []
        for x, y in zip(batch.column("s_a"), batch.column("s_b")):
            x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(LINK[1] * both >= LINK[0] * (len(x) + len(y) - both))
        yield pa.record_batch([batch.column("a"), batch.column("b")], schema=schema).filter(pa.array(ok, pa.bool_()))


def _with_sides(pairs: DataFrame, t: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the columns of ``t`` (by set_key) for both."""
    for x in ("a", "b"):
        pairs = pairs.join(t.select(F.col("set_key").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in t.columns if c != "set_key"]), x)
    return pairs


def _level(key) -> F.Column:
    """Random level of a class: each is half as likely as the one below."""
    h = F.xxhash64(key)
    return F.length(F.regexp_extract(F.bin(h), "0*$", 0)).cast("int")


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, component_key, text_hash`` of every row.

    Null or empty text (or without words) has no shingles and is linked with
    nothing. Rows with equal shingle sets are one class whatever their ids; a
    class is named by its smallest id. ``component_id`` is the smallest id in
    all linked classes (null ids only count if there is no other; an unlinked
    empty row keeps its own id); ``kept`` is true where doc_id equals it, so
    rows repeating the kept id are all kept here. An empty table gives none."""
    f = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        trimmed(_features(words)), "doc_id long, text_hash long, set_key binary, n_shingles long, regs binary"), "llm-hmh")
    classes = materialize(f.where("n_shingles > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("min_id"), F.first("n_shingles").alias("n_shingles"), F.first("regs").alias("regs")), "llm-classes")

    def keys(batches):
        for batch in batches:
            if batch.num_rows:
                k = band_keys(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, BUCKETS))
                yield pa.record_batch([pa.array(k.ravel()), batch.column(0).take(pa.array(np.repeat(np.arange(len(k)), k.shape[1])))],
                                      names=["key", "set_key"])

    bands = classes.where("regs IS NOT NULL").select("set_key", "regs").mapInArrow(trimmed(keys), "key long, set_key binary")
    shared = materialize(bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "llm-buckets")
    members = bands.join(shared, "key").join(classes.select("set_key", "n_shingles"), "set_key")
    # A size class is a little wider than the ratio at which two sets can still link.
    size = F.floor(F.log(F.col("n_shingles").cast("double")) / float(np.log(LINK[1] / LINK[0]) * 1.0000001)).cast("int")
    members = materialize(members.select(F.explode(F.array(F.xxhash64("key", size), F.xxhash64("key", size + 1))).alias("key"),
                                         "set_key", _level(F.col("set_key")).alias("lvl")), "llm-members")
    # Texts of candidate classes: the row of each class with its smallest id.
    ids = members.select("set_key").distinct().join(classes.select("set_key", "min_id"), "set_key")
    ids = materialize(ids, "llm-candidates")
    texts = docs.select("doc_id", "text").join(ids.select(F.col("min_id").alias("doc_id")).distinct(), "doc_id").select("text")
    named = texts.mapInArrow(trimmed(_sets(words)), "set_key binary, shingles binary, f binary")
    if ids.where("min_id IS NULL").limit(1).count():  # classes of which no row has an id
        named = named.unionByName(docs.where("doc_id IS NULL").select("text").mapInArrow(trimmed(_sets(words)), "set_key binary, shingles binary, f binary"))
    sets = materialize(named.join(ids.select("set_key"), "set_key", "left_semi").groupBy("set_key").agg(F.first("shingles").alias("shingles"), F.first("f").alias("f")), "llm-sets")

    # Shingles that a single candidate has (the xor over one row is that row's key).
    lone = (sets.select("set_key", "shingles").mapInArrow(trimmed(_shingle_rows), "shingle long, hi long, lo long").groupBy("shingle")
            .agg(F.count(F.lit(1)).alias("n"), F.bit_xor("hi").alias("hi"), F.bit_xor("lo").alias("lo"))
            .where("n = 1").groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("lone")))
    known = classes.select("set_key", F.col("n_shingles").alias("n"), F.col("regs").alias("r")).join(sets.select("set_key", "f"), "set_key")
    known = known.mapInArrow(trimmed(_halves), "set_key binary, n long, r binary, f binary, hi long, lo long").join(lone, ["hi", "lo"], "left")
    known = known.select("set_key", "n", (F.col("n") - F.coalesce("lone", F.lit(0))).alias("m"), "r", "f")
    known = materialize(known.where(f"{LINK[1]} * m >= {LINK[0]} * n"), "llm-known")
    members = members.join(known.select("set_key", "n", "m"), "set_key")
    comps = classes.select("set_key", F.col("set_key").alias("comp"))

    def confirm(pairs: DataFrame) -> None:
        """Confirm candidate pairs on full sets and merge what they link."""
        nonlocal comps
        p = _with_sides(pairs, sets.select("set_key", F.col("shingles").alias("s"))).select("a", "b", "s_a", "s_b")
        links = _with_sides(materialize(p.mapInArrow(trimmed(_confirmed), "a binary, b binary"), "llm-links"), comps)
        links = materialize(links.where("comp_a <> comp_b").select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")).distinct(), "llm-merges")
        if links.limit(1).count():
            c = components(links).select(F.col("node").alias("comp"), F.col("comp").alias("to"))
            comps = materialize(comps.join(c, "comp", "left").select("set_key", F.coalesce("to", "comp").alias("comp")), "llm-comps")

    def open_buckets() -> DataFrame:
        """Buckets with several components, their top level and blocks."""
        return materialize(members.join(comps, "set_key").groupBy("key").agg(
            F.max("lvl").alias("top"), F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS).cast("int").alias("parts"),
            F.min(F.xxhash64("comp")).alias("x"), F.max(F.xxhash64("comp")).alias("y")).where("x <> y").select("key", "top", "parts"), "llm-open")

    members = materialize(members, "llm-members")
    side = known.select("set_key", "n", "r", "f")
    top = open_buckets()
    if top.limit(1).count():
        rest = members.join(top, "key")
        pivots = materialize(rest.where("lvl = top").select("key", F.col("set_key").alias("p"), F.col("n").alias("p_n"), F.col("m").alias("p_m")), "llm-pivots")
        met = rest.join(pivots, "key").where("lvl < top OR set_key < p")
        # The intersection is at most what either shares with anyone.
        met = met.where(f"{LINK[1]} * least(m, p_m) >= {LINK[0]} * (n + p_n - least(m, p_m))")
        met = materialize(met.groupBy(F.col("set_key").alias("a"), F.col("p").alias("b")).agg(F.max("top").alias("lvl")), "llm-met")
        met = _with_sides(met, side).select("a", "b", "lvl", "n_a", "n_b", "r_a", "r_b", "f_a", "f_b")
        met = materialize(met.mapInArrow(trimmed(_plausible), "a binary, b binary, lvl int"), "llm-plausible")
        # First the highest pivot of each member; then what this leaves unconnected.
        best = materialize(met.groupBy("a").agg(F.max_by("b", F.struct("lvl", "b")).alias("b")), "llm-best")
        confirm(best)
        left = _with_sides(met.select("a", "b").join(best, ["a", "b"], "left_anti"), comps)
        confirm(left.where("comp_a <> comp_b").select("a", "b"))

        top = open_buckets()
        rest = members.join(top, "key").join(comps, "set_key").join(known.select("set_key", "f"), "set_key")
        rest = rest.withColumn("part", F.pmod(F.xxhash64("set_key"), F.col("parts")).cast("int"))
        blocks = rest.groupBy("key", "part").agg(F.first("parts").alias("parts"), F.collect_list(F.struct("set_key", "comp", "n", "m", "f")).alias("rows"))
        blocks = materialize(blocks, "llm-blocks")  # about BLOCK_MEMBERS rows in each
        one = blocks.withColumn("other", F.explode(F.sequence("part", F.col("parts") - 1)))
        two = blocks.select("key", F.col("part").alias("other"), F.col("rows").alias("rows_b"))
        met = one.join(two, ["key", "other"]).select("part", "other", F.col("rows").alias("rows_a"), "rows_b")
        met = met.mapInArrow(trimmed(_block_pairs), "a binary, b binary").distinct()
        met = _with_sides(materialize(met, "llm-met"), side).select("a", "b", F.lit(0).alias("lvl"), "n_a", "n_b", "r_a", "r_b", "f_a", "f_b")
        met = materialize(met.mapInArrow(trimmed(_plausible), "a binary, b binary, lvl int").select("a", "b"), "llm-plausible")
        if met.limit(1).count():
            confirm(met)

    named = classes.select("set_key", "min_id").join(comps, "set_key")
    smallest = named.groupBy("comp").agg(F.min("min_id").alias("component_id"))
    # Stored, so that a class with very many rows can be split in the last join.
    named = materialize(named.join(smallest, "comp").select("set_key", "component_id", F.col("comp").alias("component_key")), "llm-named")
    out = f.select("doc_id", "text_hash", "n_shingles", "set_key").join(named, "set_key", "left")
    cid = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", cid.alias("component_id"), F.col("doc_id").eqNullSafe(cid).alias("kept"), "component_key", "text_hash")


def one_per_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each component one row with the
    smallest id (of different texts under that id the one with the smallest
    hash, of repeated rows one); rows without words all stay."""
    n = near_duplicates(docs).where("kept AND component_key IS NOT NULL")
    one = n.groupBy("component_key").agg(F.min(F.struct("doc_id", "text_hash")).alias("o")).select(
        F.col("o.doc_id").alias("__id"), F.col("o.text_hash").alias("__hash"))
    words = F.regexp_like(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]"))
    d = docs.withColumn("__t", F.xxhash64("text"))
    stay = d.where(words).join(one, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__t") == F.col("__hash")), "left_semi")
    return stay.dropDuplicates(["doc_id", "__t"]).drop("__t").unionByName(docs.where(~words))


def op10_hyperminhash(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    d = near_duplicates(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_shingles", "component_id", "kept")


SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS sh
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
"""
