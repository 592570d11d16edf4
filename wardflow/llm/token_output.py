"""Token-id output: documents to a compressed, seekable file of ids.

Documents are dealt to ranges of doc_id; each range becomes frames of whole
documents, and a frame holds the coded blocks (:mod:`id_coder`), their
checksums and the ids and lengths of its documents. Frames are rows of a
Parquet table, so that writing is committed by Spark (a lost executor's part
files never show) and any store that Spark reaches will do."""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm import id_coder
from wardflow.llm.common import HASH_BYTES, slices, table, text_col, trimmed
from wardflow.session import ensure_checkpoint_dir

END_ID = 0
FRAME_IDS = 640 * id_coder.BLOCK   # ids in a frame, unless one document is longer
RANGE_BYTES = 24 << 20              # text in one range of ids
CACHE = 400_000                     # distinct pieces remembered in a task

FRAME = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                   ("lengths", pa.list_(pa.int64())), ("crcs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("payload", pa.binary())])
FRAME_DDL = "part int, seq int, n_ids long, doc_ids array<long>, lengths array<long>, crcs array<long>, sizes array<long>, payload binary"


class PieceEncoder:
    """Ids of texts by the tokenizers library, which sees each distinct piece once.

    A text is cut before blanks that stand before a visible Latin character, and
    before single line breaks between two of them. There the byte-level
    pre-tokenizer always ends a word, so the ids of the pieces follow each other
    as in the whole text. ``known`` holds pieces that follow a cut (without their
    blank, or with their line break), ``heads`` the first pieces of texts."""

    _OTHER = re.compile(" (?![!-~À-ɏ])")
    _BREAKS = re.compile("\n(?![!-~À-ɏ])|(?<![!-~À-ɏ])\n")
    _CUT = re.compile(" (?=[!-~À-ɏ])")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}
        self.alphabet = self.tokenizer.get_vocab_size(with_added_tokens=True)

    def forget(self) -> None:
        self.known.clear()
        self.heads.clear()

    def _pieces(self, text: str) -> list[str]:
        if self._OTHER.search(text):
            return self._CUT.split(text)
        # Every blank is a cut, so that a piece begins with a line break only here.
        return (text if self._BREAKS.search(text) else text.replace("\n", " \n")).split(" ")

    def _add(self, new: set, to: dict, before: str) -> None:
        new = list(new)
        for a in range(0, len(new), 4000):  # the library's results take about 1 KB each
            part = new[a: a + 4000]
            found = self.tokenizer.encode_batch_fast([x if x[:1] == "\n" else before + x for x in part], add_special_tokens=False)
            to.update((x, array("I", e.ids).tobytes()) for x, e in zip(part, found))

    def ids(self, texts: list) -> list[np.ndarray]:
        split = [self._pieces(t or "") for t in texts]
        heads = [s.pop(0) for s in split]
        new = set().union(*split) - self.known.keys()
        if len(self.known) + len(self.heads) + len(new) > CACHE:
            self.forget()
            new = set().union(*split)
        self._add(new, self.known, " ")
        self._add(set(heads) - self.heads.keys(), self.heads, "")
        get = self.known.__getitem__
        return [np.frombuffer(self.heads[h] + b"".join(map(get, s)), np.uint32) for h, s in zip(heads, split)]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _frames(path: str):
    def run(batches):
        enc = encoder(path)
        part, seq = TaskContext.get().partitionId(), 0
        held, names, count = [], [], 0

        def frame():
            nonlocal seq
            ids, lengths = np.concatenate(held), [len(h) for h in held]
            held.clear()
            payload, crcs = id_coder.encode(ids, enc.alphabet)
            row = pa.record_batch([pa.array([v], t) for v, t in zip(
                (part, seq, len(ids), names, lengths, crcs, [len(p) for p in payload], b"".join(payload)), FRAME.types)], schema=FRAME)
            seq += 1
            return row

        for batch in batches:
            for i, j, texts in slices(batch.column(1), HASH_BYTES):  # pieces take about 15 times their text
                for d, x in zip(batch.column(0).slice(i, j - i).to_pylist(), enc.ids(texts)):
                    if held and count + len(x) + 1 > FRAME_IDS:
                        yield frame()
                        held, names, count = [], [], 0
                    held.append(np.append(x, np.uint32(END_ID)))
                    names.append(d)
                    count += len(x) + 1
        enc.forget()  # the worker may serve other stages next
        if held:
            yield frame()
    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Write the ids of all documents, each followed by id 0, to ``path`` in
    ascending order of (doc_id, text hash).

    Null text is empty (only id 0); a null doc_id comes first; repeated rows are
    written once each; an empty table writes no frame."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_col().alias("text")).withColumn("h", F.xxhash64("text"))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    d = d.repartitionByRange(max(1, -(-size // RANGE_BYTES)), "doc_id", "h").sortWithinPartitions("doc_id", "h")
    d.select("doc_id", "text").mapInArrow(trimmed(_frames(tokenizer)), FRAME_DDL).write.parquet(path)


def read_ids(spark, path: str, tokenizer: str, digest: bool = False) -> DataFrame:
    """Decode a file of :func:`write_ids`: ``doc_id, start, n_tokens, ids``
    (ids as little-endian uint32 bytes; with ``digest`` their crc32 instead, as
    ``ids_crc32``); block checksums are verified."""
    name, kind, ddl = ("ids_crc32", pa.int64(), "long") if digest else ("ids", pa.binary(), "binary")
    value = zlib.crc32 if digest else (lambda x: x)
    f = spark.read.parquet(path)
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    totals = f.select("part", "seq", "n_ids")
    parts = totals.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn("zero", F.lit(0))  # one row per range
    parts = parts.select("part", F.coalesce(F.sum("n").over(before("zero").orderBy("part")), F.lit(0)).alias("p"))
    offsets = (totals.withColumn("q", F.coalesce(F.sum("n_ids").over(before("part").orderBy("seq")), F.lit(0)))
               .join(parts, "part").select("part", "seq", (F.col("p") + F.col("q")).alias("offset")))

    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()),
                        ("n_tokens", pa.int64()), (name, kind)])

    def run(batches):
        alphabet = encoder(tokenizer).alphabet
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                ends = np.cumsum([0] + row["sizes"])
                payload = [row["payload"][a:b] for a, b in zip(ends[:-1], ends[1:])]
                ids = id_coder.decode(payload, row["crcs"], row["n_ids"], alphabet)
                at = np.cumsum([0] + row["lengths"])
                for a in range(0, len(row["doc_ids"]), 500):
                    b = min(a + 500, len(row["doc_ids"]))
                    k = b - a
                    yield pa.record_batch([pa.array([row["part"]] * k, pa.int32()), pa.array([row["seq"]] * k, pa.int32()),
                                           pa.array(row["doc_ids"][a:b], pa.int64()), pa.array(at[a:b], pa.int64()),
                                           pa.array(row["lengths"][a:b], pa.int64()),
                                           pa.array([value(ids[at[i]: at[i + 1]].tobytes()) for i in range(a, b)], kind)], schema=schema)

    d = f.mapInArrow(trimmed(run), "part int, seq int, doc_id long, at long, n_tokens long, " + f"{name} {ddl}")
    return (d.join(offsets, ["part", "seq"])
             .select("doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", name))


def token_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the ids to a new file in the shared folder, read it back and
    return ``doc_id, start, n_tokens, ids_crc32`` per document."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/wardflow-ids-{uuid.uuid4().hex}"
    write_ids(docs, path, tokenizer)
    return read_ids(spark, path, tokenizer, digest=True)


def op2_token_output(spark, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, from the written file."""
    import public_tokenizers
    return token_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
