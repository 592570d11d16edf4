"""Benchmark decontamination by template windows, DataFrame functions only.

Tokens (runs of letters and digits) become a template: numbers, names and
units after numbers turn into typed placeholders, other tokens are case-folded.
Windows with names are also taken with the names as case-folded literals, so
that copies in capitals or title case are found.
Windows of ``window`` template tokens of the benchmark meet those of the
documents in a hash join. A window whose placeholders hold the item's values is
a match by itself. In a run of windows with other values, these must map one to
one, so that a question asked again with other numbers or names is found while
a chance meeting of placeholders is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import table, text_col

WINDOW = 8
MIN_LITERAL = 4   # with fewer tokens that are no placeholders, a window must be equal token by token
BROADCAST_ROWS = 500_000  # benchmark windows up to which they are broadcast (about 60 MB)
MARK = "\ue000"   # set before a name; a private-use character
# Units that follow a number.
UNITS = ["kg", "g", "mg", "km", "m", "cm", "mm", "l", "ml", "s", "ms", "h", "min", "hours", "hour", "minutes", "minute",
         "seconds", "second", "days", "day", "weeks", "week", "months", "month", "years", "year", "miles", "mile", "feet",
         "inches", "pounds", "dollars", "dollar", "euros", "euro", "usd", "eur", "percent", "mph", "kmh", "liters",
         "litres", "meters", "metres", "grams"]


def _tokens(text: Column) -> Column:
    """Tokens; a capitalised word inside a sentence (after a letter, digit,
    comma, colon or semicolon and a blank) gets the name mark."""
    marked = F.regexp_replace(text, r"([\p{L}\p{N},;:] )(\p{Lu})", "$1" + MARK + "$2")
    return F.filter(F.split(marked, r"[^\p{L}\p{N}" + MARK + "]+"), lambda x: x != "")


def _template(df: DataFrame) -> DataFrame:
    """``__r`` (case-folded tokens), ``__k`` (0 literal, 1 number, 2 name, 3 unit,
    4 capitalised unit, which is a name or a unit), ``__s`` and ``__n`` (whether
    there is any placeholder, any name) and two hashes of every template token:
    ``__ha`` with names as placeholders, ``__hb`` with names as literals."""
    digit = lambda c: (c >= "0") & (c < ":")  # noqa: E731  (starts with 0 to 9)
    name = lambda x: F.startswith(x, F.lit(MARK))
    prev = lambda i: F.coalesce(F.get(F.col("__t"), i - 1), F.lit(""))
    unit = lambda x, i: digit(prev(i)) & F.get(F.col("__r"), i).isin([u.upper() for u in UNITS])
    typed = lambda kind: F.xxhash64(F.lit(kind))
    # Upper case, as it also folds letters without a single capital, like the German sharp s.
    d = df.withColumn("__r", F.transform("__t", lambda x: F.upper(F.when(name(x), F.substr(x, F.lit(2))).otherwise(x))))
    d = d.withColumn("__k", F.transform("__t", lambda x, i: F.when(digit(x), 1).when(name(x), F.when(unit(x, i), 4).otherwise(2))
                                        .when(unit(x, i), 3).otherwise(0)))
    d = d.withColumn("__s", F.exists("__k", lambda k: k > 0)).withColumn("__n", F.exists("__k", lambda k: k.isin(2, 4)))
    d = d.withColumn("__hr", F.transform("__r", lambda x: F.xxhash64(x)))
    both = lambda kinds: F.zip_with("__hr", "__k", kinds)
    return (d.withColumn("__ha", F.when(F.col("__s"), both(lambda h, k: F.when(k == 0, h).when(k == 1, typed("<num>")).when(k == 3, typed("<unit>"))
                                                           .otherwise(typed("<name>")))).otherwise(F.col("__hr")))
             .withColumn("__hb", F.when(F.col("__n"), both(lambda h, k: F.when(k.isin(0, 2), h).when(k == 1, typed("<num>")).otherwise(typed("<unit>"))))))


def template_windows(df: DataFrame, keys: list[str], window: int, min_literal: int = MIN_LITERAL,
                     whole_only: bool = False) -> DataFrame:
    """(keys, pos, h, slots, way): windows with at least ``min_literal``
    literals. A window with names comes once with the names as placeholders
    (way 0) and once with the names as case-folded literals (way 1), since
    capitals do not always mean a name; one without comes once (way 2). A
    window with numbers or units comes once more without any placeholder
    (way 1), so that literal copies meet whatever the number of placeholders.
    ``whole_only``: only rows of exactly ``window`` tokens."""
    d = _template(df.select(*keys, _tokens(text_col()).alias("__t")))
    n = F.size("__t") - window + 1
    d = d.where((n == 1) if whole_only else (n >= 1))
    d = d.withColumn("__va", F.when(F.col("__s"), F.zip_with("__r", "__k", lambda r, k: F.when(k > 0, r))))
    d = d.withColumn("__vb", F.when(F.col("__s"), F.zip_with("__r", "__k", lambda r, k: F.when(k.isin(1, 3, 4), r))))
    none = F.array().cast("array<string>")
    slots = lambda values, i: F.filter(F.slice(values, i + 1, window), lambda v: v.isNotNull())
    whole = lambda hashes, i: F.xxhash64(*[F.get(F.col(hashes), i + j) for j in range(window)])
    named = lambda i: F.col("__n") & F.exists(F.slice("__k", i + 1, window), lambda k: k.isin(2, 4))
    row = lambda i, h, values, way: F.struct(i.alias("pos"), h.alias("h"), values.alias("slots"), way.alias("way"))

    def first(i: Column) -> Column:
        return row(i, whole("__ha", i), F.when(F.col("__s"), slots("__va", i)).otherwise(none),
                   F.when(named(i), 0).otherwise(2))

    def ways(w: Column) -> Column:
        i = w["pos"]
        literal = row(i, whole("__hr", i), none, F.lit(1))
        values = slots("__vb", i)
        return (F.when(F.size(w["slots"]) == 0, F.array(w)).when(w["way"] == 2, F.array(w, literal))
                .when(F.size(values) == 0, F.array(w, literal)).otherwise(F.array(w, row(i, whole("__hb", i), values, F.lit(1)), literal)))

    at = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), first)
    d = d.select(*keys, F.explode(F.flatten(F.transform(at, ways))).alias("__w"))
    return d.select(*keys, "__w.*").where(F.size("slots") <= window - min(min_literal, window))


def window_hits(df: DataFrame, keys: list[str], bench: DataFrame, window: int, min_literal: int = MIN_LITERAL,
                whole_only: bool = False) -> DataFrame:
    """The rows of :func:`template_windows` joined with ``bench`` (broadcast) on
    ``h``, where both hold as many slots; computed the other way round: every
    window is first only a position and a hash, probed in one compiled stage, and
    slots and way are looked up for the windows that meet."""
    d = _template(df.select(*keys, _tokens(text_col()).alias("__t")))
    # Three readings: names as placeholders, all tokens literal (where there is a placeholder), names literal (where there is a name).
    reading = lambda v, hashes: F.struct(F.lit(v).alias("__v"), hashes.alias("__h"))
    readings = F.array(reading(0, F.col("__ha")), reading(1, F.when(F.col("__s"), F.col("__hr"))), reading(2, F.col("__hb")))
    d = d.select(*keys, "__r", "__k", F.inline(F.filter(readings, lambda x: x["__h"].isNotNull())))
    n = F.size("__h") - window + 1
    places = F.when((n == 1) if whole_only else (n >= 1), F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    d = d.select(*keys, "__r", "__k", "__v", "__h", F.explode(places).alias("pos"))
    d = d.withColumn("h", F.xxhash64(*[F.get("__h", F.col("pos") + j) for j in range(window)])).join(F.broadcast(bench), "h")
    cut = lambda c: F.slice(c, F.col("pos") + 1, window).alias(c)
    d = d.select(*keys, "pos", *bench.columns, "__v", cut("__r"), cut("__k"))

    v = F.col("__v")
    held = lambda k: F.when(v == 0, k > 0).when(v == 2, k.isin(1, 3, 4)).otherwise(False)
    slots = F.filter(F.zip_with("__r", "__k", lambda r, k: F.when(held(k), r)), lambda x: x.isNotNull())
    named = F.exists("__k", lambda k: k.isin(2, 4))
    way = F.when(v > 0, 1).when(named, 0).otherwise(2)

    def stands(x: Column) -> Column:
        """The window has this reading, and as many slots as the benchmark's."""
        real = F.when(v == 0, True).when(v == 1, F.exists("__k", lambda k: k > 0)).otherwise(named & (F.size(x["slots"]) > 0))
        return real & (F.size(x["slots"]) <= window - min(min_literal, window)) & (F.size(x["slots"]) == F.size("b_slots"))

    # As a generator and not a filter, which would be moved into the compiled stage before the join.
    return d.select(*keys, "pos", *bench.columns, F.inline(F.filter(F.array(F.struct(slots.alias("slots"), way.alias("way"))), stands)))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_literal: int = MIN_LITERAL) -> DataFrame:
    """One row per document and benchmark item found in it: ``doc_id, item_id,
    n_windows`` (distinct matching windows of the item), ``reparameterised``
    (true if some slot value differs from the item's). Both are taken from the
    windows with names as placeholders, and only where none of them matches
    from those with names or all tokens as case-folded literals.

    Rows of equal ids and other texts are judged apart. Windows of fewer than
    ``min_literal`` literals match by equal tokens only.
    Items of fewer tokens than ``window`` are matched as one window of their own
    length; those of fewer than ``min_literal`` tokens cannot be told from chance
    inside a text and match documents that hold nothing else. Null texts and null ids of documents are kept out
    of matches only as far as they have no windows: a null id is reported as
    null. Repeated rows and equal ids report once; an empty side gives no row."""
    mark = lambda name: F.xxhash64("text").alias(name)
    b, docs = benchmark.select("item_id", "text", mark("__bt")), docs.select("doc_id", "text", mark("__dt"))
    lengths = b.select(F.size(_tokens(text_col())).alias("n")).where(F.col("n").between(1, window - 1))
    short = sorted(r["n"] for r in lengths.distinct().collect())  # at most window - 1 numbers
    parts = []
    for size in [window, *short]:
        bw = template_windows(b, ["item_id", "__bt"], size, min_literal, whole_only=size < window)
        # Ways may meet: the window of a capital copy holds names where the item's has none.
        bw = bw.select("item_id", "__bt", F.col("pos").alias("b_pos"), "h", F.col("slots").alias("b_slots"), F.col("way").alias("b_way"))
        whole_only = size < min_literal
        if bw.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
            m = window_hits(docs, ["doc_id", "__dt"], bw, size, min_literal, whole_only)
        else:  # windows are shuffled, so they must not carry their text along
            m = template_windows(docs, ["doc_id", "__dt"], size, min_literal, whole_only).join(bw, "h").where(F.size("slots") == F.size("b_slots"))
        parts.append(m.select(
            "doc_id", "__dt", "item_id", "__bt", "b_pos", (F.col("pos") - F.col("b_pos")).alias("shift"),
            F.when((F.col("way") == 1) | (F.col("b_way") == 1), F.array(F.lit(1))).when(F.col("way") == 2, F.array(F.lit(0), F.lit(1)))
             .otherwise(F.array(F.lit(0))).alias("way"),
            F.transform(F.sequence(F.lit(0), F.size("slots")), lambda i: F.struct(
                F.get(F.col("b_slots"), i).alias("b"), F.get(F.col("slots"), i).alias("d"))).alias("pairs")))
    m = parts[0]
    for p in parts[1:]:
        m = m.unionByName(p)
    m = m.withColumn("way", F.explode("way"))  # windows without names stand in both
    # Windows of equal values are run -1; consecutive ones of other values share place minus rank.
    # An alignment holds at most the windows of one item, so the sets stay small.
    keys = ["doc_id", "__dt", "item_id", "__bt", "shift", "way"]
    m = m.withColumn("pairs", F.filter("pairs", lambda s: s["b"].isNotNull()))
    m = m.withColumn("other", F.exists("pairs", lambda s: s["b"] != s["d"]))
    a = m.groupBy(*keys).agg(F.collect_set(F.when(~F.col("other"), F.col("b_pos"))).alias("same"),
                             F.sort_array(F.collect_set(F.when(F.col("other"), F.struct("b_pos", "pairs")))).alias("changed"))
    run = lambda r, at, p: F.struct(r.alias("run"), at.alias("at"), p.alias("p"))
    none = F.lit(None).cast("array<struct<b:string,d:string>>")
    a = a.withColumn("__r", F.concat(F.transform("same", lambda x: run(F.lit(-1), x, none)),
                                     F.transform("changed", lambda w, i: run(w["b_pos"] - i, w["b_pos"], w["pairs"]))))
    a = a.select(*keys, F.explode("__r").alias("__r")).select(*keys, "__r.*")
    a = a.groupBy(*keys, "run").agg(F.collect_set("at").alias("at"), F.array_distinct(F.flatten(F.collect_list("p"))).alias("p"))
    size = lambda c: F.size(F.array_distinct(F.transform("p", lambda s: s[c])))
    a = a.where((F.col("run") < 0) | (F.size("p") == size("b")) & (F.size("p") == size("d")))
    a = a.withColumn("__d", F.col("run") >= 0)
    typed = F.col("way") == 0
    places = lambda c: F.size(F.array_distinct(F.flatten(F.collect_set(c)))).cast("long")
    return a.groupBy("doc_id", "item_id").agg(
        F.when(F.max(typed), places(F.when(typed, F.col("at")))).otherwise(places("at")).alias("n_windows"),
        F.when(F.max(typed), F.max(F.when(typed, F.col("__d")))).otherwise(F.max("__d")).alias("reparameterised"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows in which no benchmark item was found. A row is known by a hash of its id
    and text, so rows without an id, and rows that share one, are judged by
    their own texts."""
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text"))
    hit = contaminated(docs.select(key.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("__hit")).distinct()
    return docs.withColumn("__key", key).join(hit, F.col("__key") == F.col("__hit"), "left_anti").drop("__key")


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_UNITS_SQL = ", ".join(f"'{u}'" for u in UNITS)
SQL = rf"""
WITH src AS (SELECT 0 AS side, doc_id AS id, coalesce(text, '') AS text FROM documents
             UNION ALL SELECT 1, item_id, coalesce(text, '') FROM benchmark),
tk AS (SELECT side, id, list_filter(string_split_regex(regexp_replace(text, '([\p{{L}}\p{{N}},;:] )(\p{{Lu}})', '\1' || chr(57344) || '\2', 'g'),
         '[^\p{{L}}\p{{N}}' || chr(57344) || ']+'), lambda x: x <> '') AS t FROM src),
u AS (SELECT side, id, t, unnest(range(1, len(t) + 1)) AS i FROM tk),
k AS (SELECT side, id, i, lower(t[i]) AS v, CASE WHEN regexp_matches(t[i], '^[0-9]') THEN '<num>' WHEN t[i][1] = chr(57344) THEN '<name>'
        WHEN i > 1 AND regexp_matches(t[i - 1], '^[0-9]') AND lower(t[i]) IN ({_UNITS_SQL}) THEN '<unit>' END AS kind FROM u),
w AS (SELECT side, id, i, list(coalesce(kind, v)) OVER x AS win, list(CASE WHEN kind IS NOT NULL THEN v END) OVER x AS vals
      FROM k WINDOW x AS (PARTITION BY side, id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
f AS (SELECT side, id, i, array_to_string(win, ' ') AS win, list_filter(vals, lambda v: v IS NOT NULL) AS slots FROM w WHERE len(win) = 8),
g AS (SELECT * FROM f WHERE len(slots) <= 4),
m AS (SELECT DISTINCT d.id AS doc_id, b.id AS item_id, b.i AS b_pos, d.i - b.i AS shift, list_zip(b.slots, d.slots) AS pairs
      FROM g d JOIN g b ON d.side = 0 AND b.side = 1 AND d.win = b.win),
a AS (SELECT doc_id, item_id, shift, list(DISTINCT b_pos) AS places, list_distinct(flatten(list(pairs))) AS p FROM m GROUP BY ALL),
c AS (SELECT * FROM a WHERE len(p) = len(list_distinct(list_transform(p, lambda s: s[1]))) AND len(p) = len(list_distinct(list_transform(p, lambda s: s[2]))))
SELECT doc_id, item_id, len(list_distinct(flatten(list(places))))::BIGINT AS n_windows,
       bool_or(len(list_filter(p, lambda s: s[1] <> s[2])) > 0) AS reparameterised FROM c GROUP BY doc_id, item_id
"""
