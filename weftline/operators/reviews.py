"""Reviews and reconciliations: approved labels (C10), review packets (C15), payloads (C19), neighbour lists (C20), totals
(C21), agreement of clusterings (V12), and selections by manifest (S15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.constraints import all_of, violations
from weftline.operators.vectors import _E, _PAIRS, kmeans, neighbours, plane, unit_rows
from weftline.plans.registry import query, sql_query, table

# ---- C10


def approval_gate(units: DataFrame, approvals: DataFrame, locales: tuple[str, ...]) -> DataFrame:
    """(rule, id, message) for approvals (level, unit, locale, name, pinned) of units (level, unit, hash): each unit needs a
    name in each locale, names are unique within a level and locale whatever their case, and approve the unit as it is."""
    key = lambda *c: F.concat_ws("/", *c)
    wanted = units.select("level", "unit", "hash", F.explode(F.array(*map(F.lit, locales))).alias("locale"))
    named = approvals.withColumn("form", F.lower(F.trim("name"))).where("form <> ''")
    missing = wanted.join(named, ["level", "unit", "locale"], "left_anti")
    unknown = approvals.join(wanted, ["level", "unit", "locale"], "left_anti")
    repeated = named.groupBy("level", "locale", "form").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    stale = named.join(wanted, ["level", "unit", "locale"]).where(~F.col("pinned").eqNullSafe(F.col("hash")))
    return all_of([
        violations("complete", missing.withColumn("k", key("level", "unit", "locale")), "k", "no approved name"),
        violations("known", unknown.withColumn("k", key("level", "unit", "locale")), "k", "no such unit"),
        violations("unique", repeated.withColumn("k", key("level", "locale", "form")), "k", "repeated name"),
        violations("pinned", stale.withColumn("k", key("level", "unit", "locale")), "k", "approved for another content"),
    ])


@query(
    "C10_approval_gate",
    """WITH u AS (SELECT n_regionkey AS level, n_nationkey AS unit, sha256(n_name || n_regionkey) AS hash FROM $nation),
    a AS (SELECT level, unit, locale, CASE WHEN unit % 6 = 1 THEN ' ' || upper(r_name) || ' ' WHEN unit % 9 = 2 THEN ' ' ELSE n_name || locale END AS name, CASE WHEN unit % 5 = 0 THEN hash || 'x' WHEN unit % 7 = 3 THEN NULL ELSE hash END AS pinned, r_name
      FROM u JOIN $nation ON n_nationkey = unit JOIN $region ON r_regionkey = level CROSS JOIN (VALUES ('en'), ('pl')) l(locale) WHERE NOT (locale = 'pl' AND unit % 4 = 0)
      UNION ALL SELECT level, 1000 + unit, 'en', 'far ' || unit, hash, NULL FROM u WHERE unit % 8 = 0),
    w AS (SELECT u.*, locale FROM u CROSS JOIN (VALUES ('en'), ('pl')) l(locale)), n AS (SELECT * FROM a WHERE trim(name) <> '')
    SELECT 'complete' AS rule, level || '/' || unit || '/' || locale AS id, 'no approved name' AS message FROM w WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.level = w.level AND n.unit = w.unit AND n.locale = w.locale)
    UNION ALL SELECT 'known', level || '/' || unit || '/' || locale, 'no such unit' FROM a WHERE unit >= 1000
    UNION ALL SELECT 'unique', level || '/' || locale || '/' || lower(trim(name)), 'repeated name' FROM n GROUP BY level, locale, lower(trim(name)) HAVING count(*) > 1
    UNION ALL SELECT 'pinned', n.level || '/' || n.unit || '/' || n.locale, 'approved for another content' FROM n JOIN u ON u.level = n.level AND u.unit = n.unit WHERE n.pinned IS DISTINCT FROM u.hash""",
)
def label_gate(spark, sf_dir):
    """Names of nations within their regions, some missing, repeated, unknown or approved for other content."""
    nations = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    hashed = nations.select(F.col("n_regionkey").alias("level"), F.col("n_nationkey").alias("unit"), "n_name", "r_name", F.sha2(F.concat("n_name", F.col("n_regionkey").cast("string")), 256).alias("hash"))
    unit = F.col("unit")
    each = hashed.select("*", F.explode(F.array(F.lit("en"), F.lit("pl"))).alias("locale")).where(~((F.col("locale") == "pl") & (unit % 4 == 0)))
    name = F.when(unit % 6 == 1, F.concat(F.lit(" "), F.upper("r_name"), F.lit(" "))).when(unit % 9 == 2, " ").otherwise(F.concat("n_name", "locale"))
    pinned = F.when(unit % 5 == 0, F.concat("hash", F.lit("x"))).when(unit % 7 == 3, None).otherwise(F.col("hash"))
    far = hashed.where(unit % 8 == 0).select("level", (unit + 1000).alias("unit"), F.lit("en").alias("locale"), F.concat(F.lit("far "), unit.cast("string")).alias("name"), F.col("hash").alias("pinned"))
    approvals = each.select("level", "unit", "locale", name.alias("name"), pinned.alias("pinned")).unionByName(far)
    return approval_gate(hashed.select("level", "unit", "hash"), approvals, ("en", "pl"))


# ---- C15


@query(
    "C15_mutual_packet",
    f"""{_PAIRS}, m AS (SELECT a.src, a.dst, round(a.sim, 6) AS sim, a.rank AS forward, b.rank AS backward FROM r a JOIN r b ON a.src = b.dst AND a.dst = b.src WHERE a.rank <= 5 AND b.rank <= 5 AND a.src < a.dst)
    SELECT m.src, m.dst, m.sim, m.forward, m.backward, x.source AS left_source, y.source AS right_source, sha256(x.text) AS left_hash, sha256(y.text) AS right_hash, CASE WHEN x.doc_id IS NULL OR y.doc_id IS NULL THEN 'no record' WHEN x.lang <> y.lang THEN 'languages differ' WHEN x.text = y.text THEN 'equal texts' ELSE 'fine' END AS state
    FROM m LEFT JOIN $documents x ON x.doc_id = m.src LEFT JOIN $documents y ON y.doc_id = m.dst""",
)
def packet(spark, sf_dir, k: int = 5):
    """Mutual neighbours with the ranks either way, their records, and whether they may be reviewed."""
    near = neighbours(unit_rows(table(spark, sf_dir, "embeddings")), k).select("src", "dst", "sim", "rank")
    back = near.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("rank").alias("backward"))
    pairs = near.where("src < dst").join(back, ["src", "dst"]).select("src", "dst", F.round("sim", 6).alias("sim"), F.col("rank").alias("forward"), "backward")
    docs = table(spark, sf_dir, "documents")
    side = lambda id_col, name: docs.select(F.col("doc_id").alias(id_col), F.col("source").alias(f"{name}_source"), F.col("lang").alias(f"{name}_lang"), F.sha2("text", 256).alias(f"{name}_hash"))
    both = pairs.join(side("src", "left"), "src", "left").join(side("dst", "right"), "dst", "left")
    state = F.when(F.col("left_hash").isNull() | F.col("right_hash").isNull(), "no record").when(F.col("left_lang") != F.col("right_lang"), "languages differ").when(F.col("left_hash") == F.col("right_hash"), "equal texts").otherwise("fine")
    return both.select("src", "dst", "sim", "forward", "backward", "left_source", "right_source", "left_hash", "right_hash", state.alias("state"))


# ---- C19


@query(
    "C19_variant_maps",
    f"WITH {_E}, a AS (SELECT vec_id, 'label' AS variant, label::BIGINT AS cluster FROM e UNION ALL SELECT vec_id, 'coarse', label // 4 FROM e UNION ALL SELECT vec_id, 'half', CASE WHEN x >= 0 THEN 1 ELSE 0 END FROM e WHERE vec_id % 10 <> 0) SELECT e.vec_id, round(any_value(e.x), 6) AS x, round(any_value(e.y), 6) AS y, string_agg(variant || '=' || cluster, ';' ORDER BY variant) AS variants, count(*) AS n FROM e JOIN a ON a.vec_id = e.vec_id GROUP BY e.vec_id",
)
def variant_maps(spark, sf_dir):
    """Points with their coordinates and a map of their cluster in each variant that assigns them."""
    x, y = plane("embedding")
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", x.alias("x"), y.alias("y"))
    variants = [e.select("vec_id", F.lit("label").alias("variant"), F.col("label").cast("long").alias("cluster")), e.select("vec_id", F.lit("coarse"), F.floor(F.col("label") / 4)), e.where("vec_id % 10 <> 0").select("vec_id", F.lit("half"), (F.col("x") >= 0).cast("long"))]
    maps = variants[0].union(variants[1]).union(variants[2]).groupBy("vec_id").agg(F.map_from_entries(F.collect_list(F.struct("variant", "cluster"))).alias("m"))
    shown = F.array_join(F.array_sort(F.transform(F.map_entries("m"), lambda p: F.concat(p["key"], F.lit("="), p["value"].cast("string")))), ";")
    return e.join(maps, "vec_id").select("vec_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), shown.alias("variants"), F.size("m").cast("long").alias("n"))


# ---- C20


def neighbour_violations(edges: DataFrame, corpus: DataFrame, coordinates: DataFrame, k: int) -> DataFrame:
    """(rule, id) of neighbour lists (src, dst, sim, rank) over a corpus (id): each row has exactly k distinct others of the
    corpus, in order of similarity, then id, within [-1, 1]; and finite coordinates (id, x, y)."""
    by = Window.partitionBy("src").orderBy("rank")
    placed = edges.withColumn("before", F.lag(F.struct((-F.col("sim")).alias("s"), F.col("dst").alias("d"))).over(by))
    each = placed.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("dst").alias("ends"), F.bool_or(F.col("src") == F.col("dst")).alias("self"), F.bool_or((F.abs("sim") > 1 + 1e-9) | F.isnan("sim") | F.col("sim").isNull()).alias("wild"), F.bool_or(F.col("before") > F.struct((-F.col("sim")).alias("s"), F.col("dst").alias("d"))).alias("unsorted"))
    lists = corpus.select(F.col("id").alias("src")).join(each, "src", "full")
    strange = edges.select("src", "dst").join(corpus.select(F.col("id").alias("dst")), "dst", "left_anti").select("src").distinct()
    odd = coordinates.where(~(F.coalesce(F.abs("x") < float("inf"), F.lit(False)) & F.coalesce(F.abs("y") < float("inf"), F.lit(False))) | F.isnan("x") | F.isnan("y"))
    rule = lambda name, rows, c="src": violations(name, rows, c, name)
    return all_of([
        rule("length", lists.where(F.coalesce("n", F.lit(0)) != k)), rule("repeated", lists.where("ends < n")), rule("self", lists.where("self")), rule("range", lists.where("wild")), rule("order", lists.where("unsorted")), rule("corpus", strange),
        rule("coordinates", corpus.join(odd.select("id"), "id", "left_semi"), "id"),
    ]).select("rule", F.col("id").cast("long").alias("id"))


@query(
    "C20_neighbour_lists",
    f"""{_PAIRS}, e AS (SELECT src, CASE WHEN src % 13 = 0 AND rank = 1 THEN src WHEN src % 19 = 0 AND rank = 2 THEN dst + 1000000 WHEN src % 29 = 0 AND rank = 4 THEN first_value(dst) OVER (PARTITION BY src ORDER BY rank) ELSE dst END AS dst, CASE WHEN src % 17 = 0 AND rank = 3 THEN sim + 2 ELSE sim END AS sim, CASE WHEN src % 23 = 0 THEN 11 - rank ELSE rank END AS rank FROM r WHERE rank <= 10 AND NOT (src % 11 = 0 AND rank = 10)),
    o AS (SELECT *, lag(sim) OVER w AS s0, lag(dst) OVER w AS d0 FROM e WINDOW w AS (PARTITION BY src ORDER BY rank)),
    l AS (SELECT src, count(*) AS n, count(DISTINCT dst) AS ends, bool_or(src = dst) AS self, bool_or(abs(sim) > 1 + 1e-9) AS wild, bool_or(s0 < sim OR s0 = sim AND d0 > dst) AS unsorted FROM o GROUP BY src)
    SELECT 'length' AS rule, src AS id FROM l WHERE n <> 10 UNION ALL SELECT 'repeated', src FROM l WHERE ends < n UNION ALL SELECT 'self', src FROM l WHERE self UNION ALL SELECT 'range', src FROM l WHERE wild UNION ALL SELECT 'order', src FROM l WHERE unsorted
    UNION ALL SELECT DISTINCT 'corpus', src FROM e WHERE dst NOT IN (SELECT vec_id FROM $embeddings) UNION ALL SELECT 'coordinates', vec_id FROM $embeddings WHERE vec_id % 31 = 0""",
)
def neighbour_lists(spark, sf_dir):
    """Lists of ten neighbours, some of which are made wrong in each way."""
    near = neighbours(unit_rows(table(spark, sf_dir, "embeddings")), 10).select("src", "dst", "sim", "rank").where("NOT (src % 11 = 0 AND rank = 10)")
    first = F.first("dst").over(Window.partitionBy("src").orderBy("rank"))
    src, rank = F.col("src"), F.col("rank")
    dst = F.when((src % 13 == 0) & (rank == 1), src).when((src % 19 == 0) & (rank == 2), F.col("dst") + 1_000_000).when((src % 29 == 0) & (rank == 4), first).otherwise(F.col("dst"))
    edges = near.select("src", dst.alias("dst"), F.when((src % 17 == 0) & (rank == 3), F.col("sim") + 2).otherwise(F.col("sim")).alias("sim"), F.when(src % 23 == 0, 11 - rank).otherwise(rank).alias("rank"))
    x, y = plane("embedding")
    at = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 62 == 0, float("nan")).when(F.col("vec_id") % 31 == 0, float("inf")).otherwise(x).alias("x"), y.alias("y"))
    return neighbour_violations(edges, at.select("id"), at, 10)


# ---- C21

sql_query(
    "C21_failed_attempts",
    """WITH d AS (SELECT user_id, sum(CASE WHEN event_type <> 'error' THEN CAST(value AS DECIMAL(18, 4)) ELSE 0 END) AS detail, sum(CASE WHEN event_type = 'error' THEN CAST(value AS DECIMAL(18, 4)) ELSE 0 END) AS failed, count(*) FILTER (WHERE event_type = 'error') AS attempts FROM $events GROUP BY user_id),
    report AS (SELECT user_id, sum(CAST(value AS DECIMAL(18, 4))) - CASE WHEN user_id % 7 = 0 THEN max(CASE WHEN event_type = 'error' THEN CAST(value AS DECIMAL(18, 4)) ELSE 0 END) ELSE 0 END AS total FROM $events GROUP BY user_id)
    SELECT d.user_id, CAST(d.detail AS DOUBLE) AS detail, CAST(d.failed AS DOUBLE) AS failed, d.attempts, CAST(r.total AS DOUBLE) AS total, CAST(r.total - d.detail - d.failed AS DOUBLE) AS gap, r.total = d.detail + d.failed AS reconciled FROM d JOIN report r ON r.user_id = d.user_id""",
)

# ---- V12


def adjusted_rand(rows: DataFrame, a: str, b: str) -> DataFrame:
    """(ari) of two labellings of the same rows: pairs that are together in both, less what chance gives."""
    pairs = lambda n: F.sum(F.col(n) * (F.col(n) - 1) / 2)
    cells = rows.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    both = cells.agg(pairs("n").alias("both"), F.sum("n").alias("all"))
    one, two = (cells.groupBy(c).agg(F.sum("n").alias("n")).agg(pairs("n").alias(c)) for c in "ab")
    joined = both.crossJoin(F.broadcast(one)).crossJoin(F.broadcast(two))
    chance = F.col("a") * F.col("b") / (F.col("all") * (F.col("all") - 1) / 2)
    most = (F.col("a") + F.col("b")) / 2
    return joined.select(F.when(most == chance, 1.0).otherwise((F.col("both") - chance) / (most - chance)).alias("ari"))


@query("V12_seed_agreement")
def seed_agreement(spark, sf_dir, k: int = 8, seeds: tuple[int, ...] = (1, 2, 3)):
    """The adjusted Rand index of k-means from different seeds, for each two. No twin: the clusters come from MLlib; tests
    compare the index with its definition."""
    rows = unit_rows(table(spark, sf_dir, "embeddings"))
    found = {s: kmeans(rows, k, starts=1, seed=s).select("id", F.col("cluster").alias(f"c{s}")) for s in seeds}
    parts = [adjusted_rand(found[a].join(found[b], "id"), f"c{a}", f"c{b}").select(F.lit(a).alias("one"), F.lit(b).alias("two"), F.round("ari", 6).alias("ari")) for a in seeds for b in seeds if a < b]
    return all_of(parts)


# ---- S15

_MANIFEST = "SELECT conv_id, 'unit-' || conv_id AS id, CASE WHEN conv_id % 9 = 4 THEN 'nowhere' ELSE max(CASE WHEN turn = 1 THEN substring(text, 1, 25) END) END AS start_heading, CASE WHEN conv_id % 11 = 5 THEN 'never' WHEN conv_id % 13 = 6 THEN max(CASE WHEN turn = 0 THEN substring(text, 1, 25) END) ELSE max_by(substring(text, 1, 25), turn) END AS end_heading FROM {conversations} GROUP BY conv_id"


def selected(blocks: DataFrame, manifest: DataFrame) -> DataFrame:
    """(book, id, error, start, blocks, body_sha256): what a manifest's entries (book, id, start_heading, end_heading) select
    of blocks (book, pos, text): from the first block that begins with the start's heading to before the first later one that
    begins with the end's. Errors: `start`, `end`, `repeated id`."""
    starts = manifest.join(blocks, "book").where(F.col("text").startswith(F.col("start_heading"))).groupBy("book", "id").agg(F.min("pos").alias("start"))
    known = manifest.join(starts, ["book", "id"], "left")
    ends = known.join(blocks, "book").where(F.col("text").startswith(F.col("end_heading")) & (F.col("pos") > F.col("start"))).groupBy("book", "id").agg(F.min("pos").alias("end"))
    counted = manifest.groupBy("id").agg(F.count(F.lit(1)).alias("entries"))
    whole = known.join(ends, ["book", "id"], "left").join(counted, "id")
    error = F.when(F.col("entries") > 1, "repeated id").when(F.col("start").isNull(), "start").when(F.col("end").isNull(), "end")
    judged = whole.select("book", "id", error.alias("error"), "start", "end")
    inside = judged.where("error IS NULL").join(blocks, "book").where((F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("end")))
    bodies = inside.groupBy("book", "id").agg(F.count(F.lit(1)).alias("blocks"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda b: b["text"]), "\n\n"), 256).alias("body_sha256"))
    return judged.join(bodies, ["book", "id"], "left").select("book", "id", "error", "start", F.coalesce("blocks", F.lit(0)).alias("blocks"), "body_sha256")


@query(
    "S15_manifest_locators",
    f"""WITH m AS ({_MANIFEST.format(conversations='$conversations')}), s AS (SELECT m.*, min(c.turn) AS start FROM m LEFT JOIN $conversations c ON c.conv_id = m.conv_id AND starts_with(c.text, m.start_heading) GROUP BY ALL),
    e AS (SELECT s.*, min(c.turn) AS stop FROM s LEFT JOIN $conversations c ON c.conv_id = s.conv_id AND starts_with(c.text, s.end_heading) AND c.turn > s.start GROUP BY ALL),
    j AS (SELECT conv_id, id, CASE WHEN start IS NULL THEN 'start' WHEN stop IS NULL THEN 'end' END AS error, start, stop FROM e)
    SELECT j.conv_id AS book, j.id, j.error, j.start, count(c.turn) AS blocks, sha256(string_agg(c.text, chr(10) || chr(10) ORDER BY c.turn)) AS body_sha256 FROM j LEFT JOIN $conversations c ON j.error IS NULL AND c.conv_id = j.conv_id AND c.turn >= j.start AND c.turn < j.stop GROUP BY j.conv_id, j.id, j.error, j.start""",
)
def manifest_locators(spark, sf_dir):
    """From each conversation the turns between two headings that a manifest names; some of its headings are nowhere."""
    talks = table(spark, sf_dir, "conversations")
    head = F.substring("text", 1, 25)
    at = lambda t: F.max(F.when(F.col("turn") == t, head))
    start = F.when(F.col("book") % 9 == 4, "nowhere").otherwise(F.col("s"))
    end = F.when(F.col("book") % 11 == 5, "never").when(F.col("book") % 13 == 6, F.col("z")).otherwise(F.col("e"))
    manifest = talks.groupBy(F.col("conv_id").alias("book")).agg(at(1).alias("s"), at(0).alias("z"), F.max_by(head, "turn").alias("e")).select("book", F.concat(F.lit("unit-"), F.col("book").cast("string")).alias("id"), start.alias("start_heading"), end.alias("end_heading"))
    return selected(talks.select(F.col("conv_id").alias("book"), F.col("turn").alias("pos"), "text"), manifest)
