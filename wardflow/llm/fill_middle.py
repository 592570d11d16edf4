"""Fill-in-the-middle rewriting of documents.

Where a text is cut is drawn in units (code points, words, lines ...), while a
string is sliced by code points. An indexable skip list translates one into the
other: the links of its express lanes carry how many units and how many code
points they pass, so descending from the top lane and adding up widths reaches
a unit rank, and the code point where it begins, in logarithmically many steps."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import mix64, slices, table

MARKS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
PLAIN_FROM = 90                 # of 100: a draw from here on leaves the text plain
SPM_BELOW = 20                  # of 100: a draw below puts the suffix first
STEP = 1 << 16                  # units looked at together while lanes are built


class SkipList:
    """Units of one text. ``unit``: a pattern whose matches (never empty), left
    to right, begin the units (what follows a match up to the next belongs to
    it, what precedes the first to the first); None for single code points.

    The lowest lane is the text itself, one unit a link. A unit is also on lane
    k with chance 16**-k, drawn from a hash of its number, so that lanes hold
    about a fifteenth of the units together."""

    def __init__(self, text: str, unit: re.Pattern | None = None):
        self.text, self.unit = text, unit
        numbers, starts, bits = [], [], []
        self.n = 0
        for begin in self._begins():
            number = np.arange(self.n, self.n + len(begin), dtype=np.int64)
            drawn = mix64(number.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
            up = np.flatnonzero((drawn & np.uint64(15)) == 0)
            up = up[number[up] > 0]
            numbers.append(number[up])
            starts.append(begin[up])
            bits.append(drawn[up])
            self.n += len(begin)
        number, start, drawn = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (numbers, starts, bits))
        self.lanes = []  # from the lowest express lane up: widths in units, in code points, place in the lane below
        below, level = np.concatenate([[0], number]), 1
        while len(number):
            n, s = np.concatenate([[0], number]), np.concatenate([[0], start])
            down = np.searchsorted(below, n) if level > 1 else n
            self.lanes.append((np.diff(np.append(n, self.n)).tolist(), np.diff(np.append(s, len(text))).tolist(), down.tolist()))
            below, level = n, level + 1
            keep = (drawn >> np.uint64(4 * level - 4) & np.uint64(15)) == 0
            number, start, drawn = number[keep], start[keep], drawn[keep]

    def _begins(self):
        """Code points at which units begin, in arrays of at most STEP."""
        if self.unit is None:
            for a in range(0, len(self.text), STEP):
                yield np.arange(a, min(a + STEP, len(self.text)))
            return
        held = []
        for m in self.unit.finditer(self.text):
            held.append(m.start())
            if len(held) == STEP:
                yield np.array(held)
                held = []
        if held:
            yield np.array(held)

    def place(self, rank: int) -> int:
        """The code point before which exactly ``rank`` units lie (0 <= rank <= n)."""
        if rank >= self.n and self.n:
            return len(self.text)
        units = chars = node = 0
        for wide, long, down in reversed(self.lanes):
            while node < len(wide) and units + wide[node] <= rank:
                units += wide[node]
                chars += long[node]
                node += 1
            node = down[node] if node < len(down) else node
        if self.unit is None or rank == units:
            return chars + rank - units
        for k, m in enumerate(self.unit.finditer(self.text, chars)):  # the lowest lane
            if units + k == rank:
                return m.start()
        return len(self.text)


def draws(doc_id, salt: str = "1:") -> list[int]:
    """Four 32-bit numbers from the sha256 of salt and decimal id (null: none)."""
    h = hashlib.sha256((salt + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    return [int(h[i: i + 8], 16) for i in range(0, 32, 8)]


def rewrite(text: str, doc_id, unit: re.Pattern | None = None, marks=MARKS, salt: str = "1:"):
    """(units, form, code points of the prefix, of the middle, output)."""
    units = SkipList(text, unit)
    a, b, form, order = draws(doc_id, salt)
    if not text or any(m in text for m in marks) or form % 100 >= PLAIN_FROM:
        return units.n, "plain", None, None, text
    cut, end = sorted((a % (units.n + 1), b % (units.n + 1)))
    x, y = units.place(cut), units.place(end)
    p, s, m = marks
    if order % 100 < SPM_BELOW:
        return units.n, "spm", x, y - x, f"{s}{text[y:]}{p}{text[:x]}{m}{text[x:y]}"
    return units.n, "psm", x, y - x, f"{p}{text[:x]}{s}{text[y:]}{m}{text[x:y]}"


def _check(marks) -> None:
    if len(set(marks)) != 3 or any(a[-k:] == b[:k] for a in marks for b in marks for k in range(1, min(len(a), len(b)))) \
            or any(a != b and a in b for a in marks for b in marks) or not all(marks):
        raise ValueError("marks must be three texts that neither overlap nor hold each other")


def fill_in_middle(docs: DataFrame, unit: str | None = None, marks=MARKS, salt: str = "1:") -> DataFrame:
    """Every row of ``docs`` with ``n`` (units), ``form``, ``prefix_chars``,
    ``middle_chars`` (code points; null if plain) and ``output``.

    Cuts are drawn from sha256 of ``doc_id``. ``unit`` is a regular expression
    that matches one unit (default: a code point). A text that is empty, null
    (taken as empty) or holds a mark stays plain, and so do a tenth of the rows.
    Text without a unit is all suffix. A null id draws like an empty one, repeated rows
    are rewritten alike, columns of the result's names are replaced, an empty
    table gives no rows. A text is held whole in one task, with arrays of about
    a tenth of its units."""
    _check(marks)
    new = ["n", "form", "prefix_chars", "middle_chars", "output"]
    columns = [c for c in docs.columns if c not in new]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)

    def run(batches):
        pattern = re.compile(unit) if unit else None
        for batch in batches:
            ids = batch.column("__id").to_pylist()
            for i, j, texts in slices(batch.column("__text")):
                made = [rewrite(t or "", d, pattern, marks, salt) for t, d in zip(texts, ids[i:j])]
                yield pa.record_batch([*(batch.column(c).slice(i, j - i) for c in columns),
                                       *(pa.array(list(v), k) for v, k in zip(zip(*made), types))], names=[*columns, *new])

    sent = docs.select(*columns, F.col("doc_id").alias("__id"), F.col("text").alias("__text"))
    return sent.mapInArrow(run, f"{ddl}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, marks=MARKS) -> Column:
    """The text that an output of :func:`fill_in_middle` was made from. In a
    form that is not plain every mark stands once."""
    p, s, m = marks
    middle = F.substring_index(output, m, -1)
    head = F.substring_index(output, m, 1)
    psm = F.concat(F.substring_index(F.substring_index(head, s, 1), p, -1), middle, F.substring_index(head, s, -1))
    spm = F.concat(F.substring_index(head, p, -1), middle, F.substring_index(F.substring_index(head, p, 1), s, -1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op13_fill_middle(spark, sf_dir: str) -> DataFrame:
    """Form, cuts and checksums of every document's rewritten and restored text."""
    d = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                    F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
     r AS (SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b, ('0x' || h[17:24])::BIGINT % 100 AS c,
                  ('0x' || h[25:32])::BIGINT % 100 AS o FROM d),
     f AS (SELECT *, least(a, b) AS x, greatest(a, b) AS y,
                  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain'
                       WHEN o < 20 THEN 'spm' ELSE 'psm' END AS form FROM r),
     g AS (SELECT *, left(t, x) AS p, substring(t, x + 1, y - x) AS m, substring(t, y + 1, n - y) AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars, CASE WHEN form <> 'plain' THEN y - x END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM g"""
