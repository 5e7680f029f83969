"""Benchmark decontamination by template canonicalisation (DataFrame functions only).

Words are canonicalised: numbers, units and names become typed placeholders,
other words are lower-cased without outer punctuation. Windows of ``WINDOW``
canonical words of the documents are hash-joined with those of the benchmark
items, which finds a question again after its numbers or names were changed.
Per document and item, the placeholders of matching windows are then compared:
one benchmark value must always stand for one value in the document, and the
other way round. A document is contaminated by an item of which it holds
``COVERAGE`` of the windows, consistently. That is asked of the document as a
whole and of each alignment by itself, so that several variants of one item
don't speak against each other: of the matches at one distance from their
places in the item, and of those at distances that lie ``BAND`` apart at most
(copies with words put in or left out). In an alignment a value left as it was
is always consistent. The figures returned are those of the document as a
whole where they suffice, else of its best alignment.

Windows are also joined by their literal words, lower-cased, which finds
copies in another case and windows that hold more placeholders than plain
words. Alignments count them: there, ``COVERAGE`` may be reached among the
windows with plain words or among all. Of long items a passage is enough: a
run of matching windows, ``RUN_WORDS`` words long and consistent by itself,
in which no window with plain words is left out.

The benchmark's windows are broadcast, as some fixed numbers each, where they
number ``BROADCAST_ROWS`` at most (``ROW_BYTES`` each); beyond that the join is
shuffled. The documents' windows are exploded and joined in one stage, and only
matches go on. Words of small letters alone, most of a text, take one test
instead of five, and a window's literal digest is made only where it differs.

Defined results: null and empty texts have no windows and match nothing; an
item shorter than a window is one window; a window of which fewer than half
the words are plain is only found word for word; repeated rows count once; rows with a null
item_id or doc_id are judged as the null id; different texts under one id are
judged each by itself, and the best figures stand; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import read_table
from .common import documents, let, words, written

WINDOW = 8
COVERAGE = 0.3
CONSISTENT = 0.8
BAND = 4
RUN_WORDS = 20
#: Windows that may be broadcast, some 13 MB.
BROADCAST_ROWS, ROW_BYTES = 200_000, 64

NUM, UNIT, NAME = "<num>", "<unit>", "<name>"
#: Words read as units.
UNITS = ("mm", "cm", "m", "km", "inch", "inches", "ft", "feet", "yard", "yards", "mile", "miles", "mg", "g", "kg", "lb", "lbs", "pounds",
         "ounces", "ml", "l", "liter", "liters", "litre", "litres", "gallons", "s", "sec", "seconds", "minutes", "min", "hours", "hour", "h",
         "days", "weeks", "months", "years", "mph", "kmh", "usd", "eur", "dollars", "dollar", "cents", "euros", "percent", "degrees",
         "celsius", "fahrenheit", "watts", "kw", "volts", "hz", "mb", "gb")
EDGE = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
NUMBER = r"^[0-9][0-9.,:/-]*$"
CAPITAL = r"^[^\p{L}\p{N}]*\p{Lu}\p{L}+"
SENTENCE_END = r"[.!?:]['\")\]]*$"
#: Words that are their own core, and neither number nor name.
PLAIN = r"^\p{Ll}+$"


def _core(w: Column) -> Column:
    return F.lower(F.regexp_replace(w, EDGE, ""))


def canonical(w: Column) -> Column:
    """(template, literal) of the words of an array, in order: the canonical
    word, and the lower-cased word without outer punctuation."""
    def form(x: Column, i: Column) -> Column:
        def of(core: Column) -> Column:
            before = F.get(w, i - 1)
            name = x.rlike(CAPITAL) & (i > 0) & ~before.rlike(SENTENCE_END)
            literal = F.when(core == "", x).otherwise(core)
            template = F.when(core == "", x).when(core.rlike(NUMBER), NUM).when(core.isin(*UNITS), UNIT).when(name, NAME).otherwise(core)
            return F.struct(template.alias("template"), literal.alias("literal"))

        plain = F.struct(F.when(x.isin(*UNITS), UNIT).otherwise(x).alias("template"), x.alias("literal"))
        return F.when(x.rlike(PLAIN), plain).otherwise(let(_core(x), of))

    return F.transform(w, form)


def _digest(c: Column, i: Column, size: int, form: str) -> Column:
    """Digest of the ``size`` canonical words from place ``i`` on: of pairs, of
    pairs of pairs and so on, which ``_rolling`` makes for all places at once."""
    level = [F.get(c, i + k)[form] for k in range(size)]
    while len(level) > 1:
        level = [F.xxhash64(*level[k : k + 2]) for k in range(0, len(level), 2)]
    return level[0] if size > 1 else F.xxhash64(level[0])


def _rolling(c: Column) -> Column:
    """Template digests of all windows of ``WINDOW`` (a power of two) words, in order."""
    def next_level(a: Column, step: int) -> Column:
        wider = F.transform(a, lambda x, i: F.xxhash64(x, F.get(a, i + step)))
        return wider if 2 * step == WINDOW else let(wider, lambda b: next_level(b, 2 * step))

    pairs = F.transform(c, lambda x, i: F.xxhash64(x.template, F.get(c, i + 1).template))
    return F.slice(let(pairs, lambda a: next_level(a, 2)), 1, F.greatest(F.size(c) - (WINDOW - 1), F.lit(0)))


def _places(c: Column, size: int) -> Column:
    """Where windows of ``size`` words begin."""
    last = F.size(c) - size
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _both_forms(c: Column, size: int) -> Column:
    """(pos, digest, template) of windows by their templates, and by their
    literal words where a placeholder makes these another digest."""
    form = lambda pos, digest, template: F.struct(pos.alias("pos"), digest.alias("digest"), F.lit(template).alias("template"))
    by_template = F.transform(_rolling(c), lambda h, i: form(i, h, True)) if size == WINDOW else \
        F.transform(_places(c, size), lambda i: form(i, _digest(c, i, size, "template"), True))
    filled = F.filter(F.transform(c, lambda x, i: F.when(x.template != x.literal, i)), lambda i: i.isNotNull())
    around = F.transform(filled, lambda i: F.sequence(F.greatest(i - (size - 1), F.lit(0)), F.least(i, F.size(c) - size)))
    literal = F.transform(F.array_distinct(F.flatten(around)), lambda i: form(i, _digest(c, i, size, "literal"), False))
    return F.when(F.size(c) >= size, F.concat(by_template, literal)).otherwise(F.slice(by_template, 1, 0))


def _with_words(rows: DataFrame, text: str) -> DataFrame:
    return rows.withColumn("w", words(F.col(text))).withColumn("c", let(F.col("w"), canonical))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_key, size, pos, before, usable, template, digest, slots,
    held) of the windows of the items; ``item_key`` tells texts under one id
    apart; ``before`` counts the usable windows before. Usable ones are there by
    their template, and all by their literal words where these give another
    digest; ``slots`` are the places in the window that hold placeholders."""
    items = _with_words(benchmark.select("item_id", "text").distinct(), "text").where(F.size("w") > 0)
    items = items.withColumn("size", F.least(F.size("w"), F.lit(WINDOW))).withColumn("item_key", F.xxhash64("w"))
    filled = lambda i: F.get(F.col("c"), i).template.isin(NUM, UNIT, NAME)

    def one(pos: Column, size: int) -> Column:
        return F.filter(F.sequence(F.lit(0), F.lit(size - 1)), lambda k: filled(pos + k))

    by_size = None
    for size in range(1, WINDOW + 1):
        found = items.where(F.col("size") == size).select(
            "item_id", "item_key", "size", "w", "c", F.explode(_places(F.col("c"), size)).alias("pos"))
        of = lambda form: _digest(F.col("c"), F.col("pos"), size, form)  # noqa: E731, B023
        found = found.select("item_id", "item_key", "size", "pos", of("template").alias("digest"), of("literal").alias("literal"),
                             one(F.col("pos"), size).alias("slots"), F.slice("w", F.col("pos") + 1, F.lit(size)).alias("held"))
        by_size = found if by_size is None else by_size.unionByName(found)
    by_size = by_size.withColumn("usable", 2 * F.size("slots") <= F.col("size"))
    so_far = F.sum(F.col("usable").cast("int")).over(Window.partitionBy("item_id", "item_key").orderBy("pos"))
    by_size = by_size.withColumn("before", so_far - F.col("usable").cast("int"))
    form = lambda template, digest: F.struct(F.lit(template).alias("template"), F.col(digest).alias("digest"))
    own, literal = F.array(form(True, "digest")), F.array(form(False, "literal"))
    forms = F.when(~F.col("usable"), literal).when(F.col("literal") == F.col("digest"), own).otherwise(F.concat(own, literal))
    return by_size.withColumn("form", F.explode(forms)).select(
        "item_id", "item_key", "size", "pos", "before", "usable", "form.template", "form.digest", "slots", "held")


#: What a text is known by: texts under one id are judged apart.
TEXT = ["doc_id", "text_key"]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def _same(a: str, b: str, columns: list[str]) -> Column:
    """Null-safe equality of columns of two aliased tables."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def matches(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(TEXT, ITEM, pos, item_pos, size, before, usable, filled, template):
    equal windows; ``template`` where both sides are templates, ``filled`` the
    number of placeholders."""
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())  # WINDOW values at most
    few = windows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    # Numbers only: the words and places of placeholders join the matches later.
    keys = windows.select(*ITEM, F.col("pos").alias("item_pos"), "size", "before", "usable", F.size("slots").alias("filled"),
                          F.col("template").alias("item_template"), "digest")
    d = _with_words(_texts(docs), "text")
    each = [F.transform(_both_forms(F.col("c"), n), lambda x: x.withField("size", F.lit(n))) if len(sizes) > 1 else _both_forms(F.col("c"), n) for n in sizes]
    all_windows = F.concat(*each) if sizes else F.array().cast("array<struct<pos:int,digest:bigint,template:boolean>>")
    exploded = d.select(*TEXT, F.explode(all_windows).alias("win")).select(*TEXT, "win.*")
    on = ["digest", "size"] if len(sizes) > 1 else ["digest"]
    found = exploded.join(F.broadcast(keys) if few else keys, on).drop("digest")
    return found.withColumn("template", F.col("template") & F.col("item_template")).drop("item_template")


ITEM = ["item_id", "item_key"]
#: What an alignment is known by; of kind WHOLE, matches of templates, there
#: is one a document and item.
ALIGNMENT = [*TEXT, *ITEM, "kind", "at"]
WHOLE, NEARBY, DIAGONAL, RUN = 0, 1, 2, 3


def _aligned(found: DataFrame) -> DataFrame:
    """The matches once for each alignment they are part of."""
    order = Window.partitionBy(*TEXT, *ITEM).orderBy("off")
    rows = found.withColumn("off", F.col("pos") - F.col("item_pos"))
    rows = rows.withColumn("apart", F.coalesce(F.col("off") - F.lag("off").over(order) > BAND, F.lit(False)))
    rows = rows.withColumn("band", F.sum(F.col("apart").cast("int")).over(order))
    along = Window.partitionBy(*TEXT, *ITEM).orderBy("off", "item_pos")
    missed = F.col("before") > F.lag(F.col("before") + F.col("usable").cast("int")).over(along)
    ends = (F.col("off") != F.lag("off").over(along)) | missed | (F.col("item_pos") - F.lag("item_pos").over(along) > F.col("size"))
    rows = rows.withColumn("ends", F.coalesce(ends, F.lit(False))).withColumn("run", F.sum(F.col("ends").cast("int")).over(along))
    key = lambda kind, at: F.struct(F.lit(kind).alias("kind"), at.cast("long").alias("at"))
    keys = F.explode(F.array(key(WHOLE, F.lit(0)), key(NEARBY, F.col("band")), key(DIAGONAL, F.col("off")), key(RUN, F.col("run"))))
    return rows.withColumn("key", keys).select("key.*", *found.columns).where((F.col("kind") != WHOLE) | F.col("template"))


def _consistency(found: DataFrame, docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(ALIGNMENT, n_slots, n_consistent) of matches with placeholders."""
    asked = found.where(F.col("filled") > 0)
    who = asked.select(*TEXT).distinct()
    some = _texts(docs).alias("d").join(who.alias("a"), _same("d", "a", TEXT), "left_semi").select(*TEXT, words(F.col("text")).alias("w")).dropDuplicates(TEXT)
    places = windows.where(F.size("slots") > 0).select(*ITEM, F.col("pos").alias("item_pos"), "slots", "held").dropDuplicates([*ITEM, "item_pos"])
    with_held = asked.alias("a").join(places.alias("p"), _same("a", "p", [*ITEM, "item_pos"])).select("a.*", "p.slots", "p.held")
    pairs = with_held.alias("a").join(some.alias("d"), _same("a", "d", TEXT)).select("a.*", "d.w").select(
        *ALIGNMENT, F.explode(F.transform("slots", lambda k: F.struct(
            (F.col("item_pos") + k).alias("place"), _core(F.get("held", k)).alias("theirs"), _core(F.get("w", F.col("pos") + k)).alias("ours")))).alias("s"),
    ).select(*ALIGNMENT, "s.theirs", "s.ours", "s.place").groupBy(*ALIGNMENT, "theirs", "ours").agg(F.countDistinct("place").alias("n"))
    # The most frequent partner of a value counts as its meaning, both ways, and in an alignment the value itself.
    itself = (F.col("kind") != WHOLE) & (F.col("theirs") == F.col("ours"))
    pairs = pairs.withColumn("kept", F.when(itself, F.col("n")).otherwise(0)).withColumn("other", F.when(itself, 0).otherwise(F.col("n")))
    most = (F.sum("kept") + F.max("other")).alias("most")
    meant = pairs.groupBy(*ALIGNMENT, "theirs").agg(F.sum("n").alias("n"), most)
    back = pairs.groupBy(*ALIGNMENT, "ours").agg(F.sum("n").alias("n"), most)
    total = lambda x, name: x.groupBy(*ALIGNMENT).agg(F.sum("n").alias("n_slots"), F.sum("most").alias(name))
    b = total(back, "b").drop("n_slots")
    return total(meant, "a").alias("x").join(b.alias("y"), _same("x", "y", ALIGNMENT)).select(
        *[f"x.{c}" for c in ALIGNMENT], "x.n_slots", F.least("x.a", "y.b").alias("n_consistent"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_windows, item_windows, n_slots, n_consistent) of
    documents that hold benchmark items."""
    windows = written(item_windows(benchmark), "bench-windows")
    found = written(_aligned(matches(docs, windows)), "bench-matches")
    total = windows.select(*ITEM, "pos", "usable").groupBy(*ITEM, "pos").agg(F.max("usable").alias("usable")) \
        .groupBy(*ITEM).agg(F.count(F.lit(1)).alias("all"), F.count_if("usable").alias("usable"))
    held = found.groupBy(*ALIGNMENT, "item_pos").agg(F.max("template").alias("template"), F.max("size").alias("size")) \
        .groupBy(*ALIGNMENT).agg(F.count(F.lit(1)).alias("n_all"), F.count_if("template").alias("n_template"),
                                 (F.max(F.col("item_pos") + F.col("size")) - F.min("item_pos")).alias("n_words"))
    hit = held.alias("h").join(total.alias("t"), _same("h", "t", ITEM)).select("h.*", "t.all", "t.usable")
    enough = (F.col("n_template") > 0) & (F.col("n_template") >= COVERAGE * F.col("usable"))
    long = (F.col("kind") == RUN) & (F.col("n_words") >= RUN_WORDS)
    hit = hit.where(enough | (F.col("n_all") >= COVERAGE * F.col("all")) | long).select(
        *ALIGNMENT, F.when(enough, F.col("n_template")).otherwise(F.col("n_all")).alias("n_windows"),
        F.when(enough, F.col("usable")).otherwise(F.col("all")).alias("item_windows"))
    if found.where(F.col("filled") > 0).isEmpty():  # nothing to compare
        judged = hit.withColumn("n_slots", F.lit(0).cast("long")).withColumn("n_consistent", F.lit(0).cast("long"))
    else:
        c = _consistency(found, docs, windows)
        judged = hit.alias("h").join(c.alias("c"), _same("h", "c", ALIGNMENT), "left").select(
            "h.*", F.coalesce("c.n_slots", F.lit(0)).alias("n_slots"), F.coalesce("c.n_consistent", F.lit(0)).alias("n_consistent"),
        ).where(F.col("n_consistent") >= CONSISTENT * F.col("n_slots"))
    figures = ["n_windows", "item_windows", "n_slots", "n_consistent"]
    best = F.max(F.struct((F.col("kind") == WHOLE).alias("whole"), *figures)).alias("best")
    return judged.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", *[F.col(f"best.{x}").alias(x) for x in figures])


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, one row a document and item."""
    return contaminated(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def oracle() -> str:
    """The same in SQL, with windows as texts in place of digests."""
    units = ", ".join(f"'{u}'" for u in UNITS)
    end = SENTENCE_END.replace("'", "''")

    def canonical_sql(table: str, key: str) -> str:
        return f"""
  SELECT row_number() OVER () AS k, {key}, w, n, list_transform(range(1, len(w) + 1), lambda i: CASE
      WHEN n[i] = '' THEN w[i]
      WHEN regexp_matches(n[i], '{NUMBER}') THEN '{NUM}'
      WHEN n[i] IN ({units}) THEN '{UNIT}'
      WHEN regexp_matches(w[i], '{CAPITAL}') AND i > 1 AND NOT regexp_matches(w[i - 1], '{end}') THEN '{NAME}'
      ELSE n[i] END) AS c,
    list_transform(range(1, len(w) + 1), lambda i: CASE WHEN n[i] = '' THEN w[i] ELSE n[i] END) AS l
  FROM (SELECT {key}, w, list_transform(w, lambda x: lower(regexp_replace(x, '{EDGE}', '', 'g'))) AS n FROM (
    SELECT DISTINCT {key}, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {table}))"""

    text = lambda c: f"array_to_string({c}[p + 1:p + size], chr(31))"
    filled = f"c[p + j + 1] IN ('{NUM}', '{UNIT}', '{NAME}')"
    al = "dk, ik, kind, spot"
    return f"""
WITH d AS MATERIALIZED ({canonical_sql("documents", "doc_id")}),
b AS MATERIALIZED ({canonical_sql("benchmark", "item_id")}),
-- windows of the items: by template where half the words are plain, and word for word
bw AS (
  SELECT k AS ik, size, p, list_filter(range(0, size), lambda j: {filled}) AS slots, {text("c")} AS gt, {text("l")} AS gl
  FROM (SELECT *, unnest(range(0, len(w) - size + 1)) AS p FROM (SELECT *, least(len(w), {WINDOW}) AS size FROM b WHERE len(w) > 0))),
bu AS (SELECT *, 2 * len(slots) <= size AS usable FROM bw),
bb AS (SELECT *, sum(usable::INT) OVER (PARTITION BY ik ORDER BY p) - usable::INT AS before FROM bu),
iw AS (
  SELECT ik, size, p, slots, usable, before, true AS template, gt AS g FROM bb WHERE usable
  UNION ALL SELECT ik, size, p, slots, usable, before, false, gl FROM bb WHERE NOT usable OR gt <> gl),
dp AS (
  SELECT k AS dk, size, p, {text("c")} AS gt, {text("l")} AS gl
  FROM (SELECT d.*, size, unnest(range(0, len(w) - size + 1)) AS p FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size)),
dw AS (SELECT dk, size, p, true AS template, gt AS g FROM dp UNION ALL SELECT dk, size, p, false, gl FROM dp WHERE gt <> gl),
m AS (
  SELECT dk, ik, dw.p AS pos, iw.p AS item_pos, iw.size, slots, usable, before, dw.template AND iw.template AS template, dw.p - iw.p AS off
  FROM dw JOIN iw USING (g, size)),
-- alignments: all matches by template, near distances, one distance, unbroken runs
m1 AS (
  SELECT *, coalesce(off - lag(off) OVER o > {BAND}, false) AS apart,
    coalesce(off <> lag(off) OVER o OR before > lag(before + usable::INT) OVER o OR item_pos - lag(item_pos) OVER o > size, false) AS ends
  FROM m WINDOW o AS (PARTITION BY dk, ik ORDER BY off, item_pos)),
m2 AS (
  SELECT *, sum(apart::INT) OVER (PARTITION BY dk, ik ORDER BY off) AS band, sum(ends::INT) OVER (PARTITION BY dk, ik ORDER BY off, item_pos) AS run
  FROM m1),
a AS (
  SELECT 0 AS kind, 0 AS spot, * FROM m2 WHERE template UNION ALL SELECT 1, band, * FROM m2
  UNION ALL SELECT 2, off, * FROM m2 UNION ALL SELECT 3, run, * FROM m2),
held AS (
  SELECT {al}, count(DISTINCT item_pos) AS n_all, count(DISTINCT item_pos) FILTER (WHERE template) AS n_template,
    max(item_pos + size) - min(item_pos) AS n_words
  FROM a GROUP BY {al}),
total AS (SELECT ik, count(*) AS n_all, count(*) FILTER (WHERE usable) AS n_usable FROM bb GROUP BY ik),
hit AS (
  SELECT held.*, t.n_all AS item_all, t.n_usable, n_template > 0 AND n_template >= {COVERAGE} * t.n_usable AS enough
  FROM held JOIN total t USING (ik)),
ok AS (
  SELECT {al}, CASE WHEN enough THEN n_template ELSE n_all END AS n_windows, CASE WHEN enough THEN n_usable ELSE item_all END AS item_windows
  FROM hit WHERE enough OR n_all >= {COVERAGE} * item_all OR (kind = 3 AND n_words >= {RUN_WORDS})),
-- slots: one value must stand for one value, both ways; in an alignment a value left as it was is right
pr AS (
  SELECT {al}, b.n[item_pos + j + 1] AS theirs, d.n[pos + j + 1] AS ours, item_pos + j AS place
  FROM (SELECT *, unnest(slots) AS j FROM a) x JOIN b ON b.k = x.ik JOIN d ON d.k = x.dk),
f AS (SELECT {al}, theirs, ours, count(DISTINCT place) AS n, kind <> 0 AND theirs = ours AS itself FROM pr GROUP BY ALL),
x AS (
  SELECT {al}, sum(n) AS n, sum(most) AS a
  FROM (SELECT {al}, theirs, sum(n) AS n, coalesce(sum(n) FILTER (WHERE itself), 0) + coalesce(max(n) FILTER (WHERE NOT itself), 0) AS most FROM f GROUP BY ALL)
  GROUP BY ALL),
y AS (
  SELECT {al}, sum(most) AS b
  FROM (SELECT {al}, ours, coalesce(sum(n) FILTER (WHERE itself), 0) + coalesce(max(n) FILTER (WHERE NOT itself), 0) AS most FROM f GROUP BY ALL)
  GROUP BY ALL),
j AS (
  SELECT ok.*, coalesce(x.n, 0) AS n_slots, coalesce(least(x.a, y.b), 0) AS n_consistent
  FROM ok LEFT JOIN x USING ({al}) LEFT JOIN y USING ({al})),
best AS (
  SELECT doc_id, item_id, n_windows, item_windows, n_slots, n_consistent,
    row_number() OVER (PARTITION BY doc_id, item_id ORDER BY kind = 0 DESC, n_windows DESC, item_windows DESC, n_slots DESC, n_consistent DESC) AS place
  FROM j JOIN d ON d.k = j.dk JOIN b ON b.k = j.ik WHERE n_consistent >= {CONSISTENT} * n_slots)
SELECT doc_id, item_id, n_windows, item_windows, n_slots::BIGINT AS n_slots, n_consistent::BIGINT AS n_consistent FROM best WHERE place = 1
"""
