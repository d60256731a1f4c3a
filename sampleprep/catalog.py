"""Every registered query over the given tables, with its SQL.

The tables hold no images, so image slots, placeholders and metadata are derived from their columns by expressions that both engines
share. Every query reads its whole table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sampleprep.functions import binary, classify, geom3d
from sampleprep.functions import text as t
from sampleprep.operators import nested, recon, shards, stats, validate
from sampleprep.plans import convert, scans
from sampleprep.session import shared_folder, ship, spread, table
from sampleprep.sources import ranges
from sampleprep.sources import shards as files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


# ---- conversations -------------------------------------------------------------------------------------------------


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    """conv_id and its turns as (from, value); roles other than user and assistant keep their name, which has no sample role."""
    rows = table(spark, sf, "conversations")
    role = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise(F.col("role"))
    turns = F.array_sort(F.collect_list(F.struct("turn", role.alias("from"), F.col("text").alias("value"))))
    made = rows.groupBy("conv_id").agg(turns.alias("turns"))
    return made.select("conv_id", F.transform("turns", lambda x: F.struct(x["from"].alias("from"), x["value"].alias("value"))).alias("conversations"))


_VALID = """
    SELECT conv_id, count(*) AS n_turns,
        bool_and(role = CASE WHEN turn % 2 = 0 THEN 'user' ELSE 'assistant' END) AS valid
    FROM conversations GROUP BY conv_id"""


@query(_VALID)
def turn_alternation(spark: SparkSession, sf: str) -> DataFrame:
    made = conversations(spark, sf)
    return made.select("conv_id", F.size("conversations").cast("long").alias("n_turns"), nested.is_valid(F.col("conversations")).alias("valid"))


@query(f"SELECT count(*) AS seen, count(*) FILTER (WHERE valid) AS converted, count(*) FILTER (WHERE NOT valid) AS skipped FROM ({_VALID})")
def skip_totals(spark: SparkSession, sf: str) -> DataFrame:
    valid = nested.is_valid(F.col("conversations"))
    return conversations(spark, sf).agg(F.count("*").alias("seen"), F.count_if(valid).alias("converted"), F.count_if(~valid).alias("skipped"))


@query("SELECT conv_id, coalesce(min_by(text, turn) FILTER (WHERE role = 'user'), '') AS first_human FROM conversations GROUP BY conv_id")
def first_human(spark: SparkSession, sf: str) -> DataFrame:
    return conversations(spark, sf).select("conv_id", t.first_human_text(F.col("conversations")).alias("first_human"))


@query("""
    WITH f AS (SELECT conv_id, coalesce(min_by(text, turn) FILTER (WHERE role = 'user'), '') AS x FROM conversations GROUP BY conv_id)
    SELECT conv_id, CASE WHEN length(x) > 80 THEN left(x, 80) || '…' ELSE x END AS snippet FROM f""")
def snippet(spark: SparkSession, sf: str) -> DataFrame:
    return conversations(spark, sf).select("conv_id", t.snippet(t.first_human_text(F.col("conversations")), 80).alias("snippet"))


def samples(spark: SparkSession, sf: str) -> DataFrame:
    """Valid conversations as samples; each has conv_id % 4 images, one of them a PNG."""
    made = conversations(spark, sf).where(nested.is_valid(F.col("conversations")))
    sample_id = t.sample_id(F.concat(F.lit("talk"), (F.col("conv_id") % 5).cast("string")), F.col("conv_id").cast("string"), F.lit(0))
    slots = F.filter(F.sequence(F.lit(0), F.lit(3)), lambda i: i < F.col("conv_id") % 4)
    mime = lambda i: F.when(i == 2, binary.PNG).otherwise(binary.JPEG)
    images = F.transform(
        slots,
        lambda i: F.struct(
            t.member_name(sample_id, i, mime(i)).alias("relative_path"),
            mime(i).alias("format"),
            ((F.col("conv_id") * 37 + i * 11) % 2000).cast("int").alias("width"),
            ((F.col("conv_id") * 53 + i * 7) % 1500).cast("int").alias("height"),
        ),
    )
    category = classify.infer_category(t.first_human_text(F.col("conversations")), F.size(images))
    made = made.select("conv_id", nested.sample(F.col("conversations"), images, sample_id, category).alias("s"))
    return made.select("conv_id", "s.*")


_SAMPLE_IDS = "SELECT conv_id, 'talk' || (conv_id % 5) || '__' || conv_id AS id FROM (SELECT DISTINCT conv_id FROM (" + _VALID + ") WHERE valid)"


@query(f"""
    SELECT conv_id, i AS place, id || '_0' || i || CASE WHEN i = 2 THEN '.png' ELSE '.jpg' END AS path
    FROM ({_SAMPLE_IDS}), range(4) r(i) WHERE i < conv_id % 4""")
def image_refs(spark: SparkSession, sf: str) -> DataFrame:
    return samples(spark, sf).select("conv_id", F.posexplode(nested.image_paths(F.col("data"))).alias("place", "path")).withColumn("place", F.col("place").cast("long"))


@query(f"""
    SELECT c.conv_id, c.turn, CASE WHEN c.turn = 0 THEN trim(regexp_replace(regexp_replace(c.text, ' +', ' ', 'g'), ' *\\n *', chr(10), 'g'), ' ' || chr(10)) ELSE c.text END AS text
    FROM conversations c JOIN ({_VALID}) v USING (conv_id) WHERE v.valid""")
def turn_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = samples(spark, sf).select("conv_id", F.posexplode("data").alias("turn", "x"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), nested.turn_text(F.col("x.content")).alias("text"))


@query(f"""
    SELECT 'talk' || (conv_id % 5) || '__' || conv_id AS id, conv_id % 5 <> 3 AS keys_ok, conv_id % 5 <> 1 AS roles_ok,
        NOT (conv_id % 5 = 1 AND conv_id % 4 > 0) AND NOT (conv_id % 5 = 2 AND n_turns > 1) AS assistant_ok, conv_id % 5 <> 4 AS user_ok
    FROM ({_VALID}) WHERE valid""")
def spec_check(spark: SparkSession, sf: str) -> DataFrame:
    """Four in five samples are broken: roles swapped, an image in an assistant's turn, another prompt, a part of an unknown type."""
    k = F.col("conv_id") % 5

    def typed(turn: Column, role: str, kind: str) -> Column:
        return F.when(turn["role"] == role, turn.withField("content", F.transform(turn["content"], lambda p: p.withField("type", F.lit(kind))))).otherwise(turn)

    swapped = F.transform("data", lambda t: t.withField("role", F.when(t["role"] == "user", "assistant").otherwise("user")))
    drawn = F.transform("data", lambda t: typed(t, "assistant", "image"))
    unknown = F.transform("data", lambda t: typed(t, "user", "video"))
    broken = F.when(k == 1, swapped).when(k == 2, drawn).when(k == 4, unknown).otherwise(F.col("data"))
    rows = samples(spark, sf).withColumns({"data": broken, "meta_prompt": F.when(k == 3, F.array(F.lit("x"))).otherwise(F.col("meta_prompt"))})
    return validate.check_samples(rows)


# ---- identifiers and sources ---------------------------------------------------------------------------------------

_SPELLINGS = ("matterport3d", "Matterpod_3D", " Matterpot-3d ", "EgoExo4D", "ego_exo 4d", "")
_SOURCE_SQL = "CASE doc_id % 7 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(_SPELLINGS)) + " ELSE source END"
_NORM_SQL = """CASE WHEN replace(replace(lower(raw), '_', '-'), ' ', '') IN ('matterport3d', 'matterpod3d', 'matterpot3d') THEN 'matterport3d'
    WHEN replace(replace(lower(raw), '_', '-'), ' ', '') IN ('egoexo4d', 'ego-exo4d') THEN 'Ego-Exo4D'
    WHEN raw = '' THEN 'unknown_source' ELSE raw END"""
_NORMAL_SOURCES = f"SELECT doc_id, {_NORM_SQL} AS source FROM (SELECT doc_id, trim(coalesce(nullif({_SOURCE_SQL}, ''), 'unknown_source')) AS raw FROM documents)"


def _spelled() -> Column:
    found = F.col("source")
    for i, s in enumerate(_SPELLINGS):
        found = F.when(F.col("doc_id") % 7 == i, s).otherwise(found)
    return found


@query(_NORMAL_SOURCES)
def source_norm(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", t.normalise_source(_spelled()).alias("source"))


@query("""
    WITH d AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'a/b ' || doc_id END AS raw_id, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE source END AS source FROM documents),
    s AS (SELECT doc_id, coalesce(source, 'unknown_source') || '__' || CASE WHEN raw_id = '' THEN 'sample_' || (1000000000 + doc_id) ELSE raw_id END AS sample_id FROM d)
    SELECT doc_id, sample_id, regexp_replace(sample_id, '[^A-Za-z0-9._-]+', '_', 'g')
        || printf('_%02d', doc_id % 120) || CASE WHEN doc_id % 2 = 0 THEN '.png' ELSE '.jpg' END AS member FROM s""")
def sample_ids(spark: SparkSession, sf: str) -> DataFrame:
    doc = F.col("doc_id")
    raw = F.when(doc % 5 == 0, "").otherwise(F.concat(F.lit("a/b "), doc.cast("string")))
    made = t.sample_id(F.when(doc % 11 != 0, F.col("source")), raw, t.row_ordinal(F.lit(1), doc))
    rows = table(spark, sf, "documents").select("doc_id", made.alias("sample_id"))
    mime = F.when(doc % 2 == 0, binary.PNG).otherwise(binary.JPEG)
    return rows.select("doc_id", "sample_id", t.member_name(F.col("sample_id"), (doc % 120).cast("int"), mime).alias("member"))


@query("""
    WITH d AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN source || '___' || doc_id WHEN 1 THEN source || '__x__' || doc_id ELSE source || '_' || doc_id END AS id FROM documents)
    SELECT doc_id, CASE WHEN contains(id, '__') THEN split_part(id, '__', 1) ELSE 'unknown_source' END AS source FROM d""")
def id_prefix(spark: SparkSession, sf: str) -> DataFrame:
    doc = F.col("doc_id").cast("string")
    made = F.when(F.col("doc_id") % 3 == 0, F.concat("source", F.lit("___"), doc)).when(F.col("doc_id") % 3 == 1, F.concat("source", F.lit("__x__"), doc)).otherwise(F.concat("source", F.lit("_"), doc))
    return table(spark, sf, "documents").select("doc_id", t.source_of_id(made).alias("source"))


# ---- placeholders --------------------------------------------------------------------------------------------------

_TOKENS_SQL = "CASE WHEN doc_id % 4 = 1 THEN '<image> ' || text ELSE replace(text, ' the ', ' <IMAGE id=1> ') END"
_TOKEN_RE = r"(?i)\s*(?:<\|image(?:_pad)?\|>|<image(?:_pad)?(?:\s[^>]*)?>)\s*"
_CLEAN_SQL = r"trim(regexp_replace(regexp_replace({0}, '[ \t\f\v]+', ' ', 'g'), ' *\n *', chr(10), 'g'), ' ' || chr(10))"


def _tokened() -> Column:
    return F.when(F.col("doc_id") % 4 == 1, F.concat(F.lit("<image> "), "text")).otherwise(F.replace(F.col("text"), F.lit(" the "), F.lit(" <IMAGE id=1> ")))


@query(f"SELECT doc_id, {_CLEAN_SQL.format(f'''regexp_replace({_TOKENS_SQL}, '{_TOKEN_RE}', ' ', 'g')''')} AS text FROM documents")
def token_strip(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", t.strip_tokens(_tokened()).alias("text"))


@query(f"SELECT doc_id, lower(trim(regexp_replace(regexp_replace({_TOKENS_SQL}, '{_TOKEN_RE}', ' ', 'g'), '\\s+', ' ', 'g'))) AS question FROM documents")
def question_norm(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", t.normalise_question(_tokened()).alias("question"))


@query(f"""
    WITH d AS (SELECT doc_id, string_split_regex({_TOKENS_SQL}, '{_TOKEN_RE}') AS c FROM documents)
    SELECT doc_id, len(c)::BIGINT - 1 AS slots, len(list_filter(c, lambda x: x <> ''))::BIGINT AS texts, list_sum(list_transform(c, lambda x: length(x)))::BIGINT AS chars FROM d""")
def token_segments(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", t.chunks(_tokened()).alias("c"))
    return rows.select(
        "doc_id",
        (F.size("c") - 1).cast("long").alias("slots"),
        F.size(F.filter("c", lambda x: x != "")).cast("long").alias("texts"),
        F.aggregate("c", F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("chars"),
    )


_LAYOUT = f"""
    SELECT doc_id, source, text AS shown, len(c) - 1 AS slots, len(c) > 1 AND c[1] <> '' AS before_, len(list_filter(c[2:len(c) - 1], lambda x: x <> '')) > 0 AS between_
    FROM (SELECT doc_id, source, text, list_transform(string_split_regex(text, '{_TOKEN_RE}'), lambda x: trim(x, ' ' || chr(10))) AS c FROM (SELECT doc_id, source, {_TOKENS_SQL} AS text FROM documents))"""


@query(f"""
    SELECT count(*) AS total, count(*) FILTER (WHERE slots = 0) AS without_placeholder, count(*) FILTER (WHERE slots > 0) AS with_placeholder,
        count(*) FILTER (WHERE before_ OR between_) AS deviant FROM ({_LAYOUT})""")
def layout_audit(spark: SparkSession, sf: str) -> DataFrame:
    return validate.layout_audit(spread(table(spark, sf, "documents").select("doc_id", "text")), _tokened())


@query(f"""
    SELECT doc_id, source, slots::BIGINT AS slots, concat_ws(',', CASE WHEN before_ THEN 'leading_text' END, CASE WHEN between_ THEN 'between_text' END) AS flags,
        CASE WHEN length(shown) > 400 THEN left(shown, 400) || '…' ELSE shown END AS snippet
    FROM ({_LAYOUT}) WHERE before_ OR between_ ORDER BY doc_id LIMIT 1""")
def first_deviant(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", "source", _tokened().alias("text"))
    return validate.first_deviant(rows, F.col("text"), ["doc_id"]).drop("text").withColumn("slots", F.col("slots").cast("long"))


@query(ORACLES["first_deviant"])
def first_deviant_waves(spark: SparkSession, sf: str) -> DataFrame:
    """The same row from texts in several files, read in waves until one has a hit; the folder stays, as Spark may read it again."""
    rows = table(spark, sf, "documents").select("doc_id", "source", _tokened().alias("text"))
    folder = f"{shared_folder(spark)}/texts-{uuid.uuid4().hex}"
    rows.repartitionByRange(8, "doc_id").sortWithinPartitions("doc_id").write.parquet(folder)
    row = scans.first_deviant(spark, folder, F.col("text"))
    found = spark.createDataFrame([] if row is None else [tuple(row[c] for c in ("doc_id", "source", "slots", "flags", "snippet"))], "doc_id long, source string, slots long, flags string, snippet string")
    return found


@query(f"""
    WITH d AS (SELECT doc_id, string_split_regex({_TOKENS_SQL}, '{_TOKEN_RE}') AS c, {_TOKENS_SQL} AS raw FROM documents),
    n AS (SELECT *, len(c) - 1 AS slots, len(c) - 1 + (doc_id % 3 = 0)::INT AS images FROM d),
    p AS (
        SELECT doc_id, 2 * i + 1 AS ord, 'text' AS type, {_CLEAN_SQL.format('c[i + 1]')} AS value FROM n, range(slots + 1) r(i) WHERE images = slots AND images > 0
        UNION ALL SELECT doc_id, 2 * i AS ord, 'image' AS type, printf('d_%02d.jpg', i - 1) AS value FROM n, range(1, slots + 1) r(i) WHERE images = slots AND images > 0
        UNION ALL SELECT doc_id, i AS ord, 'image' AS type, printf('d_%02d.jpg', i) AS value FROM n, range(images) r(i) WHERE NOT (images = slots AND images > 0)
        UNION ALL SELECT doc_id, images AS ord, 'text' AS type, {_CLEAN_SQL.format(f'''regexp_replace(raw, '{_TOKEN_RE}', ' ', 'g')''')} AS value FROM n WHERE NOT (images = slots AND images > 0))
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ord) - 1 AS place, type, value FROM p WHERE value <> ''""")
def interleave_parts(spark: SparkSession, sf: str) -> DataFrame:
    rows = spread(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", _tokened().alias("text"))
    n = t.slot_count(F.col("text")) + F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0)
    # a generator keeps the count from being worked out again for each image
    rows = rows.select("doc_id", "text", F.explode(F.array(n)).alias("n"))
    numbers = F.filter(F.sequence(F.lit(0), F.col("n")), lambda i: i < F.col("n"))
    images = F.transform(numbers, lambda i: F.struct(t.member_name(F.lit("d"), i, F.lit(binary.JPEG)).alias("relative_path"), F.lit(binary.JPEG).alias("format"), i.alias("width"), i.alias("height")))
    parts = rows.select("doc_id", F.posexplode(nested.interleave(F.col("text"), images)).alias("place", "p"))
    return parts.select("doc_id", F.col("place").cast("long").alias("place"), "p.type", F.coalesce("p.text.string", "p.image.relative_path").alias("value"))


# ---- classification ------------------------------------------------------------------------------------------------

_QUESTIONS = (
    "Is the {0} bigger than the {1}?", "How many {0}s are there?", "What is the distance between the {0} and the {1} (in meters)?",
    "Which of {0} and {1} is closer to the wall?", "Is the {0} from the first image visible in the second image?", "What is the height of the {0}?",
    "Order the two {0} according to their depth from near to far.", "Is it on the left, the {0}?", "From the multi-view objects {0}, {1}, identify the one farthest from the door.",
    "Find the 3D bounding box that encapsulates the {0} in this visual representation.", "Does the camera translate past the {0}?", "Tell me about the {0}.",
    "Based on the 3D positions of the objects, which one is placed at a higher elevation?", "", "Out of the objects: {0}, which one is the largest in size?",
    "Create comprehensive spatial relationship descriptions that capture every observable detail in 100-200 words.",
    "If the {0} is to the left of the {1} in the first image, what direction is the door from the {1}?",
)
#: What each question is, worked out by hand: with at most one image, and with more.
_LABELS = (
    ("size.single_view", "size.single_view"), ("counting.single_view", "counting.single_view"), ("distance.single_view", "distance.multi_view"), ("distance.single_view", "distance.multi_view"),
    ("correspondence.multi_view", "correspondence.multi_view"), ("size.single_view", "size.single_view"), ("depth.single_view", "depth.single_view"), ("position.single_view", "position.multi_view"),
    ("distance.multi_view", "distance.multi_view"), ("grounding_3d.single_view", "grounding_3d.single_view"), ("camera_motion.multi_view", "camera_motion.multi_view"),
    ("position.single_view", "camera_motion.multi_view"), ("position.single_view", "position.single_view"), ("unknown.single_view", "unknown.multi_view"), ("size.multi_view", "size.multi_view"),
    ("3d_scene_caption.single_view", "3d_scene_caption.single_view"), ("position.multi_view", "position.multi_view"),
)
def _questions() -> Column:
    found = F.lit("")
    for i, q in enumerate(_QUESTIONS):
        parts = [F.col(p) if p in ("p_name", "p_brand") else F.lit(p) for p in q.replace("{0}", "\0p_name\0").replace("{1}", "\0p_brand\0").split("\0")]
        found = F.when(F.col("p_partkey") % len(_QUESTIONS) == i, F.concat(*parts)).otherwise(found)
    return found


_LABEL_SQL = "CASE p_partkey % " + str(len(_LABELS)) + " " + " ".join(f"WHEN {i} THEN CASE WHEN p_partkey % 3 > 1 THEN '{many}' ELSE '{few}' END" for i, (few, many) in enumerate(_LABELS)) + " END"
_CLASSIFIED = f"SELECT p_partkey, p_brand AS source, p_partkey % 3 AS n_images, {_LABEL_SQL} AS category FROM part"


def classified(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("source"), _questions().alias("q"), (F.col("p_partkey") % 3).alias("n_images"))
    return rows.select("p_partkey", "source", "n_images", classify.infer_category(F.col("q"), F.col("n_images")).alias("category"))


@query(f"SELECT p_partkey, category FROM ({_CLASSIFIED})")
def classify_questions(spark: SparkSession, sf: str) -> DataFrame:
    return classified(spark, sf).select("p_partkey", "category")


_META_SQL = """CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 7 = 1 THEN 'not json' WHEN event_id % 7 = 2 THEN '[{}, ' || replace(props, '"k"', '"label"') || ', {"task": "late"}]'
    WHEN event_id % 7 = 3 THEN replace(props, '"k"', '"other"') WHEN event_id % 7 = 4 THEN '{"category": "", "ability": "see"}' ELSE replace(props, '"k"', '"task"') END"""


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    e, props = F.col("event_id") % 7, F.col("props")
    key = lambda name: F.replace(props, F.lit('"k"'), F.lit(f'"{name}"'))
    meta = F.when(e == 1, "not json").when(e == 2, F.concat(F.lit("[{}, "), key("label"), F.lit(', {"task": "late"}]'))).when(e == 3, key("other")).when(e == 4, '{"category": "", "ability": "see"}').when(e > 4, key("task"))
    rows = table(spark, sf, "events").select("event_id", meta.alias("meta_info"))
    field, value = classify.resolve_category(rows.columns, F.col("meta_info"), F.lit("position.single_view"))
    return rows.select("event_id", field.alias("field"), value.alias("category"))


_RESOLVED = f"""
    SELECT event_id, CASE WHEN k = 2 THEN 'meta_info[].label' WHEN k = 4 THEN 'meta_info.ability' WHEN k > 4 THEN 'meta_info.task' ELSE 'inferred_subtask_from_prompt' END AS field,
        CASE WHEN k = 2 THEN json_extract_string(m, '$[1].label') WHEN k = 4 THEN json_extract_string(m, '$.ability') WHEN k > 4 THEN json_extract_string(m, '$.task') ELSE 'position.single_view' END AS category
    FROM (SELECT event_id, event_id % 7 AS k, CASE WHEN event_id % 7 IN (2, 4, 5, 6) THEN {_META_SQL} END AS m FROM events)"""


@query(_RESOLVED)
def category_resolution(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf)


@query(f"SELECT min_by(field, event_id) AS category_field, count(*) AS rows FROM ({_RESOLVED})")
def category_field(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf).agg(F.min_by("field", "event_id").alias("category_field"), F.count("*").alias("rows"))


def _dist_sql(key: str, rows: str) -> str:
    return f"SELECT {key}, count(*) AS n, round_even(count(*)::DOUBLE / sum(count(*)) OVER (), 6)::DOUBLE AS ratio FROM ({rows}) GROUP BY {key}"


@query(_dist_sql("category", _CLASSIFIED))
def category_dist(spark: SparkSession, sf: str) -> DataFrame:
    return stats.distribution(classified(spark, sf), "category")


@query(_dist_sql("source", _NORMAL_SOURCES))
def source_dist(spark: SparkSession, sf: str) -> DataFrame:
    return stats.distribution(source_norm(spark, sf), "source")


@query(_dist_sql("n_images", f"SELECT n_images::BIGINT AS n_images FROM ({_CLASSIFIED})"))
def image_count_hist(spark: SparkSession, sf: str) -> DataFrame:
    return stats.distribution(classified(spark, sf), "n_images")


@query(" UNION ALL ".join(f"SELECT '{c}' AS dimension, {c}::VARCHAR AS key, count(*) AS n, round_even(count(*)::DOUBLE / sum(count(*)) OVER (), 6)::DOUBLE AS ratio FROM ({_CLASSIFIED}) GROUP BY {c}" for c in ("category", "source", "n_images")))
def all_dists(spark: SparkSession, sf: str) -> DataFrame:
    return stats.distributions(classified(spark, sf), "category", "source", "n_images")


# ---- image geometry ------------------------------------------------------------------------------------------------

_SLOTS = "SELECT l_shipmode_ AS source, w, h FROM (SELECT l_returnflag || '-' || l_linestatus AS l_shipmode_, (l_partkey * 3) % 2600 AS w, (l_suppkey * 37) % 2100 AS h FROM lineitem)"


#: Bounds and labels are written out here, so that the other side doesn't share the library's.
_MP_SQL = """CASE WHEN NOT (w > 0 AND h > 0) THEN 'unknown' WHEN (w * h)::DOUBLE / 1000000.0 < 0.05 THEN '<0.05 MP' WHEN (w * h)::DOUBLE / 1000000.0 < 0.15 THEN '0.05–0.15 MP'
    WHEN (w * h)::DOUBLE / 1000000.0 < 0.5 THEN '0.15–0.5 MP' WHEN (w * h)::DOUBLE / 1000000.0 < 1.0 THEN '0.5–1 MP' WHEN (w * h)::DOUBLE / 1000000.0 < 2.0 THEN '1–2 MP'
    WHEN (w * h)::DOUBLE / 1000000.0 < 4.0 THEN '2–4 MP' ELSE '≥4 MP' END"""
_EDGE_SQL = """CASE WHEN NOT (w > 0 AND h > 0) THEN 'unknown' WHEN least(w, h) < 320 THEN '<320 px' WHEN least(w, h) < 480 THEN '320–479 px' WHEN least(w, h) < 640 THEN '480–639 px'
    WHEN least(w, h) < 768 THEN '640–767 px' WHEN least(w, h) < 1024 THEN '768–1023 px' ELSE '≥1024 px' END"""
_MP_LIST = "['<0.05 MP', '0.05–0.15 MP', '0.15–0.5 MP', '0.5–1 MP', '1–2 MP', '2–4 MP', '≥4 MP', 'unknown']"
_EDGE_LIST = "['<320 px', '320–479 px', '480–639 px', '640–767 px', '768–1023 px', '≥1024 px', 'unknown']"


def image_slots(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem")
    return rows.select(F.concat_ws("-", "l_returnflag", "l_linestatus").alias("source"), (F.col("l_partkey") * 3 % 2600).alias("width"), (F.col("l_suppkey") * 37 % 2100).alias("height"))


def _ordered_buckets(dist: DataFrame, bounds: tuple) -> DataFrame:
    order = F.array_position(F.array(*[F.lit(b) for b in stats.bucket_order(bounds)]), F.col("bucket"))
    return dist.withColumn("place", order)


@query(f"SELECT *, list_position({_MP_LIST}, bucket)::BIGINT AS place FROM ({_dist_sql('bucket', f'SELECT {_MP_SQL} AS bucket FROM ({_SLOTS})')})")
def mp_buckets(spark: SparkSession, sf: str) -> DataFrame:
    rows = image_slots(spark, sf).select(stats.megapixel_bucket(F.col("width"), F.col("height")).alias("bucket"))
    return _ordered_buckets(stats.distribution(rows, "bucket"), stats.MEGAPIXELS)


@query(f"SELECT *, list_position({_EDGE_LIST}, bucket)::BIGINT AS place FROM ({_dist_sql('bucket', f'SELECT {_EDGE_SQL} AS bucket FROM ({_SLOTS})')})")
def edge_buckets(spark: SparkSession, sf: str) -> DataFrame:
    rows = image_slots(spark, sf).select(stats.short_edge_bucket(F.col("width"), F.col("height")).alias("bucket"))
    return _ordered_buckets(stats.distribution(rows, "bucket"), stats.SHORT_EDGES)


def _geometry_sql(scope: str, where: str) -> str:
    base = f"SELECT source, w, h, {_MP_SQL} AS mp, {_EDGE_SQL} AS edge, (w > 0 AND h > 0) AS known FROM ({_SLOTS})"
    ends = ", ".join(f"{f}(CASE WHEN known THEN {c} END) AS {n}_{f}" for c, n in (("w", "width"), ("h", "height")) for f in ("min", "max")) if where else ", ".join(f"NULL::BIGINT AS {n}" for n in ("width_min", "width_max", "height_min", "height_max"))
    nulls = ", ".join(f"NULL::BIGINT AS {n}" for n in ("width_min", "width_max", "height_min", "height_max"))
    parts = [f"SELECT {scope} AS scope, 'total' AS kind, NULL AS bucket, count(*) AS n, count(*) FILTER (WHERE NOT known) AS unknown, {ends} FROM b {where}"]
    for kind, col in (("megapixel", "mp"), ("short_edge", "edge")):
        group = f"{where}, {col}" if where else f"GROUP BY {col}"
        parts.append(f"SELECT {scope} AS scope, '{kind}' AS kind, {col} AS bucket, count(*) AS n, count(*) FILTER (WHERE NOT known) AS unknown, {nulls} FROM b {group}")
    return f"WITH b AS ({base}) " + " UNION ALL ".join(parts)


@query(_geometry_sql("NULL::VARCHAR", "").replace("NULL::VARCHAR AS scope, ", ""))
def resolution_global(spark: SparkSession, sf: str) -> DataFrame:
    return stats.geometry(image_slots(spark, sf)).where("scope is null").drop("scope")


@query(_geometry_sql("source", "GROUP BY source"))
def resolution_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return stats.geometry(image_slots(spark, sf)).where("scope is not null")


@query(ORACLES["resolution_by_source"])
def resolution_states(spark: SparkSession, sf: str) -> DataFrame:
    """resolution_by_source from states of three parts, of which one is taken again in place of a state of half of it."""
    slots = image_slots(spark, sf).withColumn("part", F.pmod(F.xxhash64("source", "width", "height"), F.lit(3)))
    states = [stats.geometry_states(slots.where(F.col("part") == k), "part") for k in range(3)]
    stale = stats.geometry_states(slots.where("part = 1 and width % 2 = 0"), "part")
    kept = states[0].unionByName(stale).where("part <> 1")
    return stats.merge_geometry(kept.unionByName(states[1]).unionByName(states[2])).where("scope is not null")


@query(f"""
    WITH m AS (SELECT source, {_MP_SQL} AS bucket FROM ({_SLOTS})), s AS (SELECT source, count(*) AS total FROM m GROUP BY source ORDER BY total DESC, source LIMIT 3),
    b AS (SELECT unnest({_MP_LIST}) AS bucket)
    SELECT s.source, b.bucket, (SELECT count(*) FROM m WHERE m.source = s.source AND m.bucket = b.bucket) AS n FROM s, b""")
def heatmap_dense(spark: SparkSession, sf: str) -> DataFrame:
    made = stats.geometry(image_slots(spark, sf)).where("kind = 'megapixel' and scope is not null").select(F.col("scope").alias("source"), "bucket", "n")
    return stats.dense_heatmap(made, 3, stats.MEGAPIXELS)


# ---- payloads ------------------------------------------------------------------------------------------------------

_PAYLOAD_SQL = """CASE doc_id % 6 WHEN 0 THEN base64(encode('abc' || doc_id)) WHEN 1 THEN 'data:image/png;base64,' || base64(encode('x' || doc_id))
    WHEN 2 THEN NULL WHEN 3 THEN '' WHEN 4 THEN 'abcde' ELSE '!' || base64(encode('zz' || doc_id)) || '!' END"""


def _payloads() -> Column:
    coded = lambda head: F.base64(F.encode(F.concat(F.lit(head), F.col("doc_id").cast("string")), "UTF-8"))
    k = F.col("doc_id") % 8
    early, skipped = F.concat(F.lit("YWI="), coded("x")), F.concat(F.lit("YW=Jj="), F.translate(coded("ab"), "=", ""), F.lit("=!="))
    return F.when(k == 6, early).when(k == 7, skipped).when(k == 0, coded("abc")).when(k == 1, F.concat(F.lit("data:image/png;base64,"), coded("x"))).when(k == 3, "").when(k == 4, "abcde").when(k == 5, F.concat(F.lit("!"), coded("zz"), F.lit("!")))


@query("""
    SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'abc' || doc_id WHEN 1 THEN 'x' || doc_id WHEN 5 THEN 'zz' || doc_id WHEN 6 THEN 'ab' WHEN 7 THEN 'abcab' || doc_id END AS payload FROM documents""")
def slot_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Slots in base64 of several forms: a data-URL, other characters between, padding that ends the data early, padding that is skipped."""
    rows = table(spark, sf, "documents").select("doc_id", _payloads().alias("slot"))
    return rows.select("doc_id", F.decode(binary.payload(F.col("slot"), rows.schema["slot"].dataType, data_url=True), "UTF-8").alias("payload"))


def _hex(value, digits: int = 2):
    return F.lpad(F.hex(value.cast("long")), digits, "0")


def _chunk(kind: str, body):
    """A chunk of a PNG in hex digits, of hex digits."""
    kind = F.lit(kind.encode().hex().upper())
    return F.concat(_hex(F.length(body) / 2, 8), kind, body, _hex(F.crc32(F.unhex(F.concat(kind, body))), 8))


def _png(width, height, depth: int, colour: int, rows: list, palette: list | None = None, transparency=None):
    """A PNG in hex digits, its bytes (columns of numbers, filter bytes included) stored uncompressed."""
    n = len(rows)
    total, weighted = (sum((w * c for w, c in zip(ws, rows, strict=True)), F.lit(0)) for ws in ([1] * n, range(n, 0, -1)))
    stored = f"780101{n:02X}00{255 - n:02X}FF"
    body = F.concat(F.lit(stored), *[_hex(c) for c in rows], _hex((weighted + n) % 65521, 4), _hex((total + 1) % 65521, 4))
    head = F.concat(_hex(width, 8), _hex(height, 8), F.lit(f"{depth:02X}{colour:02X}000000"))
    more = [_chunk("PLTE", F.concat(*[_hex(c) for c in palette]))] if palette else []
    more += [_chunk("tRNS", _hex(transparency))] if transparency is not None else []
    return F.concat(F.lit("89504E470D0A1A0A"), _chunk("IHDR", head), *more, _chunk("IDAT", body), _chunk("IEND", F.lit("")))


def _grey_jpeg(width):
    """A grey JPEG of one row of blocks in hex digits."""
    table = lambda k: f"FFC40014{k}01" + "00" * 16
    head = "FFD8FFE000046162FFDB004300" + "01" * 64 + "FFC0000B080008"
    return F.concat(F.lit(head), _hex(width, 4), F.lit("01011100" + table("00") + table("10") + "FFDA0008010100003F00" + "00" * 8 + "FFD9"))


def _whole_and_broken(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id and slot in base64: whole files, two that don't decode, and files that are broken in one way each."""
    number = 1 + F.col("doc_id") % 250
    rgb = lambda width, height: _png(width, height, 8, 2, [F.lit(0), number, F.lit(7), F.col("doc_id") % 9])
    whole, jpeg = rgb(F.lit(1), F.lit(1)), _grey_jpeg(number)
    k = F.col("doc_id") % 12
    flipped = F.translate(F.substring(whole, F.length(whole) - 25, F.lit(2)), "0123456789ABCDEF", "FEDCBA9876543210")  # the last byte of a checksum
    data = (
        F.when(k == 0, whole).when(k == 1, jpeg).when(k == 4, rgb(F.lit(0), F.lit(1))).when(k == 5, _hex(F.col("doc_id"), 8))
        .when(k == 6, F.left(whole, F.length(whole) - 10)).when(k == 7, F.concat(F.left(whole, F.length(whole) - 26), flipped, F.right(whole, F.lit(24))))
        .when(k == 8, F.left(jpeg, F.length(jpeg) - 4)).when(k == 9, rgb(F.lit(1), F.lit(2))).when(k == 10, F.concat(F.left(jpeg, F.lit(40)), F.lit("FFD9"))).when(k == 11, F.concat(whole, F.lit("00FF")))
    )
    return table(spark, sf, "documents").select("doc_id", F.when(k == 3, "a").otherwise(F.base64(F.unhex(data))).alias("slot"))


@query("""
    WITH s AS (SELECT doc_id % 12 AS k FROM documents)
    SELECT count(*) AS checked, count(*) FILTER (WHERE k IN (0, 1, 11)) AS ok, count(*) FILTER (WHERE k IN (2, 3)) AS decode_failed, count(*) FILTER (WHERE k BETWEEN 4 AND 10) AS invalid FROM s""")
def slot_validity(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    rows = _whole_and_broken(spark, sf)
    decoded = rows.select(binary.payload(F.col("slot"), rows.schema["slot"].dataType).alias("decoded"))
    return stats.slot_validity(decoded.select("decoded", binary.readable(F.col("decoded")).alias("readable")))


@query("""
    SELECT doc_id, CASE doc_id % 12 WHEN 2 THEN 'empty' WHEN 3 THEN 'empty' WHEN 4 THEN 'bad header' WHEN 5 THEN 'unknown format' WHEN 6 THEN 'truncated' WHEN 7 THEN 'bad checksum'
        WHEN 8 THEN 'truncated' WHEN 9 THEN 'truncated' WHEN 10 THEN 'truncated' END AS defect FROM documents""")
def image_defects(spark: SparkSession, sf: str) -> DataFrame:
    """Why each slot of slot_validity can't be decoded; a slot that isn't base64 is empty."""
    ship(spark)
    rows = _whole_and_broken(spark, sf)
    return rows.select("doc_id", binary.defect(binary.payload(F.col("slot"), rows.schema["slot"].dataType)).alias("defect"))


@query("""
    WITH b AS (SELECT o_orderkey, o_orderkey % 5 AS k, o_custkey % 256 AS p, o_orderkey % 251 AS s, (o_orderkey * 7 + o_custkey) % 256 AS q, o_custkey % 1000 AS v FROM orders)
    SELECT o_orderkey, CASE WHEN k = 4 THEN -1 ELSE 2 END::INTEGER AS width, CASE WHEN k = 4 THEN -1 ELSE 2 END::INTEGER AS height,
        CASE k WHEN 0 THEN 'RGB' WHEN 1 THEN 'RGBA' WHEN 2 THEN 'RGBA' WHEN 3 THEN 'RGB' END AS mode,
        CASE k WHEN 0 THEN printf('%02X%02X%02X%02X%02X%02X%02X%02X%02X000000', p, s, q, s, q, p, q, p, s)
            WHEN 1 THEN printf('%02X%02X%02X%02X%02X%02X%02XFF%02X%02X%02XFF000000FF', p, s, q, q, s, q, p, q, p, s)
            WHEN 2 THEN printf('%02X%02X%02X%02X%02X%02X%02X%02X%02X%02X%02X%02X%02X%02X%02X%02X', p, p, p, s, s, s, s, q, q, q, q, p, p, p, p, q)
            WHEN 3 THEN printf('%02X%02X%02X070707FFFFFF%02X%02X%02X', least(v, 255), least(v, 255), least(v, 255), s, s, s) END AS pixels FROM b""")
def png_modes(spark: SparkSession, sf: str) -> DataFrame:
    """PNGs of two by two pixels with a palette, with a palette and transparency, of grey with alpha, of grey of 16 bits, and a truncated one, written for output and read again."""
    ship(spark)
    p, s, q, v = F.col("o_custkey") % 256, F.col("o_orderkey") % 251, (F.col("o_orderkey") * 7 + F.col("o_custkey")) % 256, F.col("o_custkey") % 1000
    two, z, k = F.lit(2), F.lit, F.col("o_orderkey") % 5
    # the first row differs from the left pixel (filter 1), the second from the one above (2)
    index, colours = [z(1), z(0), z(1), z(2), z(2), z(2)], [p, s, q, s, q, p, q, p, s]
    less = lambda a, b: F.pmod(a - b, F.lit(256))
    alpha = [z(1), p, s, less(s, p), less(q, s), z(2), less(q, p), less(p, s), less(p, s), less(q, q)]
    high, low = F.floor(v / 256), v % 256
    deep = [z(0), high, low, z(0), z(7), z(2), less(z(1), high), less(z(44), low), z(0), less(s, z(7))]
    plain, clear = _png(two, two, 8, 3, index, colours), _png(two, two, 8, 3, index, colours, q)
    data = F.when(k == 0, plain).when(k == 1, clear).when(k == 2, _png(two, two, 8, 4, alpha)).when(k == 3, _png(two, two, 16, 0, deep)).otherwise(F.left(plain, F.length(plain) - 40))
    made = table(spark, sf, "orders").select("o_orderkey", binary.geometry(F.unhex(data)).alias("image"))
    read = made.select("o_orderkey", "image.width", "image.height", binary.pixels(F.col("image.payload")).alias("x"))
    return read.select("o_orderkey", "width", "height", "x.mode", F.hex("x.pixels").alias("pixels"))


@query("""
    WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 9 THEN NULL WHEN count(l_orderkey) = 0 THEN [] ELSE list(l_linenumber) END AS l FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey),
    s AS (SELECT coalesce(len(l), 0) AS slots, CASE WHEN l IS NULL THEN 'unsupported' WHEN len(l) = 0 THEN 'empty_list' ELSE 'list_of_dict' END AS shape FROM o)
    SELECT shape, CASE WHEN shape IS NULL THEN 1 ELSE 0 END::TINYINT AS overall, count(*) AS rows, sum(slots)::BIGINT AS slots, count(*) FILTER (WHERE slots = 0) AS without_slots, round_even(avg(slots), 6)::DOUBLE AS average
    FROM s GROUP BY GROUPING SETS ((shape), ())""")
def shape_census(spark: SparkSession, sf: str) -> DataFrame:
    return stats.census(order_images(spark, sf)).withColumn("overall", F.col("overall").cast("tinyint"))


def order_images(spark: SparkSession, sf: str) -> DataFrame:
    """slots and shape of each order's lines as an image column; null for every tenth order."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").alias("path"))).alias("l"))
    rows = table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    empty = F.array().cast(rows.schema["l"].dataType)
    rows = rows.select(F.when(F.col("o_orderkey") % 10 != 9, F.coalesce("l", empty)).alias("images"))
    slots, shape = binary.image_shape(F.col("images"), rows.schema["images"].dataType)
    return rows.select(slots.alias("slots"), shape.alias("shape"))


@query("SELECT slots, count(*) AS n FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 9 THEN 0 ELSE count(l_orderkey) END::INTEGER AS slots FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey) GROUP BY slots")
def slot_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return stats.slot_histogram(order_images(spark, sf))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (1 + l_partkey % 4000)::INTEGER AS width, (1 + l_suppkey % 3000)::INTEGER AS height,
        CASE l_partkey % 5 WHEN 0 THEN 'L' WHEN 1 THEN 'RGB' WHEN 2 THEN 'RGBA' WHEN 3 THEN '1' END AS mode FROM lineitem""")
def png_geometry(spark: SparkSession, sf: str) -> DataFrame:
    width, height, k = 1 + F.col("l_partkey") % 4000, 1 + F.col("l_suppkey") % 3000, F.col("l_partkey") % 5
    depth = F.when(k == 3, "01").otherwise("08")
    colour = F.when(k == 1, "02").when(k == 2, "06").when(k == 4, "03").otherwise("00")
    size = lambda x: F.lpad(F.hex(x.cast("long")), 8, "0")
    data = F.unhex(F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), size(width), size(height), depth, colour, F.lit("000000")))
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", binary.png_header(data).alias("x"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "x.width", "x.height", "x.mode")


# ---- shards and pages ----------------------------------------------------------------------------------------------

_SHARD = 96
_ASSIGNED = f"SELECT doc_id, source, ord AS ordinal, (ord // {_SHARD})::INTEGER AS shard_id, (ord % {_SHARD})::INTEGER AS line_idx FROM (SELECT doc_id, source, row_number() OVER (ORDER BY source, doc_id) - 1 AS ord FROM documents)"


def assigned(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", "source")
    return shards.assign_shards(shards.write_ordinals(rows, "source", "doc_id"), _SHARD)


@query(_ASSIGNED)
def shard_assign(spark: SparkSession, sf: str) -> DataFrame:
    return assigned(spark, sf).select("doc_id", "source", "ordinal", "shard_id", "line_idx")


_INDEX = f"SELECT shard_id, n, (sum(n) OVER (ORDER BY shard_id) - n)::BIGINT AS start, (sum(n) OVER (ORDER BY shard_id) - 1)::BIGINT AS \"end\" FROM (SELECT shard_id, count(*) AS n FROM ({_ASSIGNED}) GROUP BY shard_id)"


def shard_table(spark: SparkSession, sf: str) -> DataFrame:
    return shards.prefix_sums(shards.shard_counts(assigned(spark, sf), _SHARD, emit_trailing_empty=False), "shard_id", "n")


@query(_INDEX)
def shard_index(spark: SparkSession, sf: str) -> DataFrame:
    return shard_table(spark, sf)


@query(f"SELECT doc_id, o AS ordinal, (o // {_SHARD})::INTEGER AS shard_id, o % {_SHARD} AS line_idx FROM (SELECT doc_id, (doc_id * 7) % (SELECT count(*) FROM documents) AS o FROM documents)")
def ordinal_lookup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id")
    asked = docs.select("doc_id", (F.col("doc_id") * 7 % docs.agg(F.count("*")).scalar()).alias("ordinal"))
    return shards.locate(asked, shard_table(spark, sf))


@query(f"SELECT shard_id, n, (n % 16 = 0 OR shard_id = max(shard_id) OVER ()) AS size_ok FROM (SELECT shard_id, count(*) AS n FROM ({_ASSIGNED}) GROUP BY shard_id)")
def shard_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return validate.shard_sizes(shards.shard_counts(assigned(spark, sf), _SHARD, emit_trailing_empty=False))


@query(f"""
    WITH a AS (SELECT DISTINCT shard_id FROM ({_ASSIGNED}) WHERE doc_id % 5 <> 0), b AS (SELECT DISTINCT shard_id + (shard_id % 3 = 2)::INT * 1000 AS shard_id FROM ({_ASSIGNED}))
    SELECT shard_id, a.shard_id IS NOT NULL AS has_text, b.shard_id IS NOT NULL AS has_archive FROM a FULL JOIN b USING (shard_id)""")
def shard_pairing(spark: SparkSession, sf: str) -> DataFrame:
    rows = assigned(spark, sf)
    archives = rows.select((F.col("shard_id") + F.when(F.col("shard_id") % 3 == 2, 1000).otherwise(0)).alias("shard_id"))
    return recon.pair_shards(rows.where("doc_id % 5 <> 0"), archives)


@query("""
    WITH f AS (SELECT i // 100 AS file_index, doc_id, row_number() OVER (PARTITION BY i // 100 ORDER BY doc_id) - 1 AS row_in_file FROM (SELECT doc_id, doc_id AS i FROM documents))
    SELECT file_index::BIGINT AS file_index, row_in_file, doc_id FROM f ORDER BY file_index, row_in_file LIMIT 250""")
def capped_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", F.floor(F.col("doc_id") / 100).alias("file_index"))
    rows = rows.withColumn("row_in_file", (F.row_number().over(W.partitionBy("file_index").orderBy("doc_id")) - 1).cast("long"))
    return shards.capped(rows, 250).select("file_index", "row_in_file", "doc_id")


@query(f"SELECT doc_id, ordinal FROM ({_ASSIGNED}) WHERE ordinal BETWEEN 30 AND 39")
def page_seq(spark: SparkSession, sf: str) -> DataFrame:
    return shards.page(assigned(spark, sf), 4).select("doc_id", "ordinal")


@query(f"SELECT shard_id, line_idx, doc_id FROM ({_ASSIGNED}) WHERE source = 'src3' AND (shard_id > 0 OR line_idx > 5) ORDER BY shard_id, line_idx LIMIT 10")
def page_filtered(spark: SparkSession, sf: str) -> DataFrame:
    rows = assigned(spark, sf).where(t.normalise_source(F.col("source")) == t.normalise_source(F.lit(" src3 ")))
    return shards.filtered_page(rows, (0, 5)).select("shard_id", "line_idx", "doc_id")


@query(f"""
    WITH s AS ({_SAMPLE_IDS}), f AS (SELECT conv_id, min_by(text, turn) AS x FROM conversations GROUP BY conv_id)
    SELECT conv_id FROM s WHERE conv_id % 5 = 2 AND conv_id % 4 > 1""")
def browse_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = samples(spark, sf)
    return rows.where(nested.matches(F.col("id"), F.col("category"), F.col("data"), want_source="talk2", images="multi")).select("conv_id")


@query(f"SELECT conv_id FROM ({_SAMPLE_IDS}) WHERE conv_id % 4 > 1")
def browse_category(spark: SparkSession, sf: str) -> DataFrame:
    rows = samples(spark, sf)
    return rows.where(nested.matches(F.col("id"), F.col("category"), F.col("data"), want_category="camera_motion.multi_view")).select("conv_id")


@query(f"SELECT shard_id, line_idx, doc_id FROM ({_ASSIGNED}) WHERE line_idx < 7")
def line_cap(spark: SparkSession, sf: str) -> DataFrame:
    return shards.first_of_each_file(assigned(spark, sf), 7, "line_idx").select("shard_id", "line_idx", "doc_id")


@query(f"SELECT shard_id, 'd' || doc_id || '.txt' AS path FROM ({_ASSIGNED}) WHERE doc_id % 3 = 0 OR doc_id % 7 = 0")
def unresolved_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Of every path its shard should hold, a third lies in the next shard and a seventh nowhere."""
    rows = assigned(spark, sf).withColumn("path", F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".txt")))
    members = rows.where("doc_id % 7 <> 0").select((F.col("shard_id") + F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0)).alias("shard_id"), F.col("path").alias("name"))
    return validate.missing_members(rows.select("shard_id", "path"), members)


def written(spark: SparkSession, sf: str) -> str:
    """The folder of shards of documents: a sample for each with one image, whose member (the text) every seventh lacks; every fifth has a member more that it doesn't name, every eleventh no id.

    The folder stays, as rows are read from it.
    """
    doc = F.col("doc_id").cast("string")
    docs = table(spark, sf, "documents").select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    index = docs.groupBy("source").agg(F.count("*").alias("n"))
    # sources stand for files, in order; there are few
    index = index.select(F.col("source").alias("s"), (F.row_number().over(W.orderBy("source")) - 1).alias("file_index"))
    name = F.concat(F.lit("d"), doc, F.lit(".txt"))
    turns = F.array(F.struct(F.lit("human").alias("from"), F.lit("q").alias("value")))
    image = F.struct(F.lit(binary.PNG).alias("format"), F.lit(1).alias("width"), F.lit(1).alias("height"), name.alias("relative_path"))
    sample = nested.sample(turns, F.array(image), F.when(F.col("doc_id") % 11 > 0, F.concat(F.lit("d__"), doc)), F.lit("none"))
    member = F.struct(name.alias("name"), F.encode("text", "UTF-8").alias("payload"))
    extra = F.struct(F.concat(F.lit("x"), name).alias("name"), F.encode(doc, "UTF-8").alias("payload"))
    members = F.array_compact(F.array(F.when(F.col("doc_id") % 7 > 0, member), F.when(F.col("doc_id") % 5 == 0, extra)))
    rows = docs.join(F.broadcast(index), F.col("source").eqNullSafe(F.col("s"))).select("file_index", F.col("doc_id").alias("row_in_file"), sample.alias("sample"), members.alias("members"))
    root = f"{shared_folder(spark)}/written-{uuid.uuid4().hex}"
    convert.write_shards(rows, root, _SHARD, emit_trailing_empty=False)
    return root


@query(f"SELECT shard_id, line_idx, 'd__' || doc_id AS id FROM ({_ASSIGNED}) WHERE doc_id % 11 > 0 ORDER BY shard_id, line_idx LIMIT 50 OFFSET 100")
def browse_cursor(spark: SparkSession, sf: str) -> DataFrame:
    """The third page of fifty filtered samples of written shards, by the cursor that the first two leave."""
    root, cursor, rows = written(spark, sf), scans.Cursor(), []
    for _ in range(3):
        rows, cursor = scans.next_page(spark, root, cursor, 50, want_source="d", images="single")
    return spark.createDataFrame([(r.shard_id, r.line_idx, r.id) for r in rows], "shard_id int, line_idx int, id string")


@query(f"SELECT ordinal, shard_id, line_idx, CASE WHEN doc_id % 11 > 0 THEN 'd__' || doc_id END AS id FROM ({_ASSIGNED}) WHERE ordinal % 97 = 0")
def line_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Every 97th sample of written shards, read from its place in the line files."""
    root = written(spark, sf)
    index = ranges.line_index(spark, root, stride=16)
    counts = index.groupBy("shard_id").agg(F.sum("n").alias("n"))
    asked = table(spark, sf, "documents").agg(F.count("*").alias("n")).select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(97).cast("long"))).alias("ordinal"))
    found = shards.locate(asked, shards.prefix_sums(counts, "shard_id", "n"))
    lines = ranges.lines_at(spark, root, found, index, stride=16)
    read = lines.select(F.col("shard_id").alias("s"), F.col("line_idx").alias("l"), F.get_json_object("value", "$.id").alias("id"))
    return found.join(read, (F.col("shard_id") == F.col("s")) & (F.col("line_idx") == F.col("l"))).select("ordinal", "shard_id", F.col("line_idx").cast("int").alias("line_idx"), "id")


@query(f"""
    SELECT shard_id, 'd' || doc_id || '.txt' AS name, strlen(coalesce(text, ''))::BIGINT AS size, md5(coalesce(text, '')) AS digest
    FROM ({_ASSIGNED}) JOIN documents USING (doc_id) WHERE doc_id % 7 > 0 AND doc_id % 3 = 0""")
def member_fetch(spark: SparkSession, sf: str) -> DataFrame:
    """The payloads of every third document's member, read by the index of members."""
    root = written(spark, sf)
    named = table(spark, sf, "documents").where("doc_id % 3 = 0").select(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"))
    wanted = ranges.last_members(ranges.member_index(spark, root)).join(named, "name", "left_semi")
    return ranges.fetch_members(spark, root, wanted).select("shard_id", "name", "size", F.md5("payload").alias("digest"))


@query(f"""
    SELECT shard_id, true AS has_text, true AS has_archive, count(*) AS n, 0::BIGINT AS broken, count(*) FILTER (WHERE doc_id % 11 = 0) AS bad_keys, 0::BIGINT AS bad_roles,
        0::BIGINT AS bad_assistant, 0::BIGINT AS bad_user, count(*) FILTER (WHERE doc_id % 7 = 0) AS unresolved,
        count(*) FILTER (WHERE doc_id % 7 > 0) + count(*) FILTER (WHERE doc_id % 5 = 0) AS members, count(*) FILTER (WHERE doc_id % 5 = 0) AS unreferenced,
        count(*) % 16 = 0 OR shard_id = max(shard_id) OVER () AS size_ok FROM ({_ASSIGNED}) GROUP BY shard_id""")
def dataset_validation(spark: SparkSession, sf: str) -> DataFrame:
    return convert.validate_dataset(spark, written(spark, sf))


@query(f"""
    SELECT shard_id, line_idx::INTEGER AS line_idx, 'd__' || doc_id AS id, 'd' || doc_id || '.txt' AS name, octet_length(encode(coalesce(text, '')))::BIGINT AS size, md5(coalesce(text, '')) AS digest
    FROM ({_ASSIGNED.replace('SELECT doc_id, source, ord', 'SELECT doc_id, source, text, ord').replace('FROM (SELECT doc_id, source,', 'FROM (SELECT doc_id, source, text,')})""")
def tar_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as samples with their texts as archive members, and read back from lines and archives; the folder stays, as the rows are read from it."""
    doc = F.col("doc_id").cast("string")
    docs = table(spark, sf, "documents").select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    index = docs.groupBy("source").agg(F.count("*").alias("n"))
    # sources stand for files, in order; there are few
    index = index.select(F.col("source").alias("s"), (F.row_number().over(W.orderBy("source")) - 1).alias("file_index"))
    turns = F.array(F.struct(F.lit("human").alias("from"), F.lit("q").alias("value")))
    sample = nested.sample(turns, F.array().cast(f"array<{binary.IMAGE}>").cast("array<struct<format:string,width:int,height:int,relative_path:string>>"), F.concat(F.lit("d__"), doc), F.lit("none"))
    member = F.struct(F.concat(F.lit("d"), doc, F.lit(".txt")).alias("name"), F.encode("text", "UTF-8").alias("payload"))
    rows = docs.join(F.broadcast(index), F.col("source").eqNullSafe(F.col("s"))).select("file_index", F.col("doc_id").alias("row_in_file"), sample.alias("sample"), F.array(member).alias("members"))
    root = f"{shared_folder(spark)}/roundtrip-{uuid.uuid4().hex}"
    convert.write_shards(rows, root, _SHARD, emit_trailing_empty=False)
    lines = files.read_samples(spark, root, lines=True).select("shard_id", F.col("line_idx").cast("int").alias("line_idx"), "id")
    members = files.read_members(spark, root, payload=True).select(F.col("shard_id").alias("m"), "name", "size", F.md5("payload").alias("digest"))
    held = (F.col("shard_id") == F.col("m")) & (F.concat(F.lit("d"), F.substring_index("id", "__", -1), F.lit(".txt")) == F.col("name"))
    return lines.join(members, held).select("shard_id", "line_idx", "id", "name", "size", "digest")


# ---- joins ---------------------------------------------------------------------------------------------------------

@query("SELECT l_orderkey, max(struct_pack(a := l_linenumber, b := l_partkey, c := l_suppkey)).a AS line, max(struct_pack(a := l_linenumber, b := l_partkey, c := l_suppkey)).b AS part FROM lineitem GROUP BY l_orderkey")
def last_wins(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), "l_suppkey")
    return recon.last_wins(rows, "l_orderkey", ["line", "part", "l_suppkey"], ["line", "part"])


@query("SELECT count(*) - count(DISTINCT l_orderkey * 100 + l_linenumber) AS duplicates FROM lineitem")
def duplicate_ids(spark: SparkSession, sf: str) -> DataFrame:
    return recon.duplicate_count(table(spark, sf, "lineitem").select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id")), "id")


_REFERENCES = "SELECT DISTINCT 'o' || l_orderkey || '_' || l_linenumber || '.jpg' AS path FROM lineitem"
_MEMBERS = "SELECT 'o' || l_orderkey || '_' || l_linenumber || '.jpg' AS name, max(l_suppkey % 9) AS size FROM lineitem WHERE l_partkey % 11 <> 0 GROUP BY ALL"


@query(f"""
    WITH j AS (SELECT path, size, size % 4 <> 3 AS ok FROM ({_REFERENCES}) LEFT JOIN ({_MEMBERS}) ON path = name),
    c AS (SELECT count(*) AS checked, count(*) FILTER (WHERE size IS NULL) AS missing, count(*) FILTER (WHERE size = 0) AS empty, count(*) FILTER (WHERE size > 0 AND NOT ok) AS unreadable FROM j)
    SELECT *, missing + empty + unreadable AS abnormal FROM c""")
def missing_members(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem")
    name = F.concat(F.lit("o"), "l_orderkey", F.lit("_"), "l_linenumber", F.lit(".jpg"))
    size = F.col("l_suppkey") % 9
    members = rows.where("l_partkey % 11 <> 0").select(F.lit(0).alias("shard_id"), name.alias("name"), size.alias("size"), (size % 4 != 3).alias("readable"))
    return recon.check_references(rows.select(name.alias("path")).distinct(), members)


@query("""
    WITH s AS (SELECT o_orderkey AS k, 's__' || o_orderkey AS sample_id, 1 + o_orderkey % 3 AS n FROM orders),
    g AS (SELECT k, sample_id, n, i::INTEGER AS slot FROM s, range(3) r(i) WHERE i < greatest(n, CASE WHEN k % 5 = 0 THEN 0 ELSE 2 END)),
    e AS (SELECT *, (k % 5 <> 0 AND slot < 2) AS listed, CASE WHEN slot < n AND (k + slot) % 7 <> 0 THEN 1000 + k % 500 END AS src FROM g),
    m AS (SELECT *, CASE WHEN listed OR k % 2 = 0 THEN '.jpg' WHEN k % 3 = 0 THEN '.png' ELSE '' END AS ext FROM e)
    SELECT sample_id, slot, sample_id || '_0' || slot || CASE WHEN ext = '' THEN '.jpg' ELSE ext END AS image_id, src / 1024.0::DOUBLE AS source_kb,
        CASE WHEN ext <> '' AND NOT (listed AND k % 2 = 1) THEN (900 + k % 700) / 1024.0::DOUBLE END AS output_kb,
        CASE WHEN ext <> '' AND NOT (listed AND k % 2 = 1) THEN src / 1024.0::DOUBLE - (900 + k % 700) / 1024.0::DOUBLE END AS diff_kb FROM m""")
def reconcile_sizes(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("s__"), k.cast("string")).alias("sample_id"))
    sizes = F.filter(F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda i: F.struct(i.alias("i"), F.when((k + i) % 7 != 0, 1000 + k % 500).alias("v"))), lambda x: x["i"] < 1 + k % 3)
    source = rows.select("sample_id", F.transform(sizes, lambda x: x["v"]).alias("sizes"))
    name = lambda slot, mime: t.member_name(F.col("sample_id"), F.lit(slot), F.lit(mime))
    outputs = rows.where(k % 5 != 0).select("sample_id", F.array(name(0, binary.JPEG), name(1, binary.JPEG)).alias("paths"))
    jpg, png = rows.where(k % 2 == 0), rows.where((k % 2 != 0) & (k % 3 == 0))
    size = (900 + k % 700).alias("size")
    members = jpg.select(F.explode(F.array(*[name(i, binary.JPEG) for i in range(3)])).alias("name"), size).unionByName(png.select(F.explode(F.array(*[name(i, binary.PNG) for i in range(3)])).alias("name"), size))
    return recon.reconcile(source, outputs, members)


@query("""
    WITH s AS (SELECT o_orderkey AS k, 's__' || o_orderkey AS sample_id, 1 + o_orderkey % 3 AS n FROM orders),
    g AS (SELECT k, sample_id, i::INTEGER AS slot, (k + i) % 7 <> 0 AS good, sum(((k + i) % 7 <> 0)::INT) OVER (PARTITION BY k ORDER BY i) - 1 AS nth FROM s, range(3) r(i) WHERE i < n),
    p AS (SELECT k, nth AS place, slot AS named FROM g WHERE good AND k % 5 <> 0),
    j AS (SELECT g.*, coalesce(p.named, g.slot) AS shown FROM g LEFT JOIN p ON p.k = g.k AND p.place = g.slot)
    SELECT sample_id, slot, sample_id || '_0' || shown || '.jpg' AS image_id, CASE WHEN good THEN (1000 + k % 500) / 1024.0::DOUBLE END AS source_kb,
        CASE WHEN k % 2 = 0 THEN (900 + shown + k % 700) / 1024.0::DOUBLE END AS output_kb,
        CASE WHEN good AND k % 2 = 0 THEN (1000 + k % 500) / 1024.0::DOUBLE - (900 + shown + k % 700) / 1024.0::DOUBLE END AS diff_kb FROM j""")
def reconcile_parity(spark: SparkSession, sf: str) -> DataFrame:
    """Output lists leave out slots that don't decode, and are read by place: what follows a gap is held against the slot before."""
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("s__"), k.cast("string")).alias("sample_id"))
    slots = F.sequence(F.lit(0), (k % 3).cast("int"))
    source = rows.select("sample_id", F.transform(slots, lambda i: F.when((k + i) % 7 != 0, 1000 + k % 500)).alias("sizes"))
    name = lambda i: t.member_name(F.col("sample_id"), i, F.lit(binary.JPEG))
    outputs = rows.where(k % 5 != 0).select("sample_id", F.transform(F.filter(slots, lambda i: (k + i) % 7 != 0), name).alias("paths"))
    members = rows.where(k % 2 == 0).select("sample_id", "o_orderkey", F.explode(slots).alias("i")).select(name(F.col("i")).alias("name"), (900 + F.col("i") + k % 700).alias("size"))
    return recon.reconcile(source, outputs, members, parity=True)


@query(f"""
    SELECT sample_id, slot, image_id || chr(9) || coalesce(printf('%.6f', source_kb), '') || chr(9) || coalesce(printf('%.6f', output_kb), '') || chr(9) || coalesce(printf('%.6f', diff_kb), '') AS line
    FROM ({ORACLES['reconcile_sizes']})""")
def size_report(spark: SparkSession, sf: str) -> DataFrame:
    kb = [F.col(f"{k}_kb") for k in ("source", "output", "diff")]
    return reconcile_sizes(spark, sf).select("sample_id", "slot", recon.report_line(F.col("image_id"), *kb).alias("line"))


@query("""
    WITH c AS (SELECT conv_id, min_by(text, turn) AS user_text, max_by(text, turn) AS last FROM conversations GROUP BY conv_id)
    SELECT conv_id, CASE conv_id % 3 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 0 END::BIGINT AS boxes, (conv_id % 3 > 0 AND conv_id % 2 = 0) AS shown FROM c""")
def overlay_eligibility(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(F.min_by("text", "turn").alias("user_text"))
    k = F.col("conv_id")
    user = F.concat(F.when(k % 2 == 0, "hfov=60, vfov = 45.5, width=256, HEIGHT=192. ").otherwise("hfov=60. "), F.translate("user_text", "=", " "))
    nine = "[0, 0, 3, 1, 1, 1, 0.1, 0.2, 0.3]"
    answer = F.when(k % 3 == 1, f"{{'bbox_3d': {nine}}}").when(k % 3 == 2, f'[{{"bbox_3d": {nine}}}, {{"bbox_3d": [1]}}, {{"label": "x", "bbox_3d": {nine}}}]').otherwise("none")
    ship(spark)
    found = geom3d.overlay(user, answer)
    return rows.select("conv_id", F.size(geom3d.boxes(answer)).cast("long").alias("boxes"), found.isNotNull().alias("shown"))


# ---- rankings ------------------------------------------------------------------------------------------------------


@query("SELECT p_type AS key, count(*) AS n FROM part GROUP BY p_type ORDER BY n DESC, key LIMIT 5")
def topk_sources(spark: SparkSession, sf: str) -> DataFrame:
    dist = table(spark, sf, "part").groupBy(F.col("p_type").alias("key")).agg(F.count("*").alias("n"))
    return stats.top_k(dist, 5)


@query("""
    WITH d AS (SELECT p_brand AS key, count(*) AS n FROM part GROUP BY p_brand), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, key) AS k, count(*) OVER () AS keys FROM d),
    g AS (SELECT CASE WHEN keys <= 6 OR k < 6 THEN key ELSE 'others' END AS key, sum(n)::BIGINT AS n FROM r GROUP BY 1)
    SELECT key, n, (n / sum(n) OVER ())::DOUBLE AS share FROM g""")
def topn_others(spark: SparkSession, sf: str) -> DataFrame:
    dist = table(spark, sf, "part").groupBy(F.col("p_brand").alias("key")).agg(F.count("*").alias("n"))
    return stats.top_with_rest(dist, 6).withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy()))


@query("""
    SELECT event_id, 'k' AS key, json_extract(props, '$.k')::BIGINT AS n FROM events""")
def dist_parse(spark: SparkSession, sf: str) -> DataFrame:
    number = F.regexp_extract("props", r"(-?\d+)", 1)
    made = F.concat(F.lit('{"k": {"count": '), number, F.lit(', "ratio": 0.5}, "bad": 3, "worse": {"count": "x"}}'))
    rows = table(spark, sf, "events").select("event_id", F.explode(stats.parse_distribution(made)).alias("e"))
    return rows.select("event_id", "e.key", "e.n")


# ---- geometry of boxes ---------------------------------------------------------------------------------------------


@query("""
    SELECT conv_id, turn, CASE WHEN conv_id % 3 <> 0 THEN (40 + conv_id % 50)::DOUBLE + 0.25 END AS hfov, CASE WHEN conv_id % 3 <> 0 THEN (30 + turn)::DOUBLE END AS vfov,
        CASE WHEN conv_id % 3 <> 0 THEN 256.0::DOUBLE END AS width, CASE WHEN conv_id % 3 <> 0 THEN 192.0::DOUBLE END AS height FROM conversations""")
def camera_params(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations")
    head = F.format_string("Horizontal HFOV = %d.25, and vertical fov, vfov=%d. Image width=256 and ", 40 + F.col("conv_id") % 50, 30 + F.col("turn"))
    text = F.concat(head, F.when(F.col("conv_id") % 3 != 0, "height=192. ").otherwise("no more. "), "text")
    rows = rows.select("conv_id", "turn", geom3d.camera(text).alias("c"))
    return rows.select("conv_id", "turn", "c.hfov", "c.vfov", "c.width", "c.height")


def _box_text() -> Column:
    number = F.transform(F.slice("embedding", 1, 10), lambda x: F.round(x.cast("double") * 1000).cast("long").cast("string"))
    nine, eight = F.array_join(F.slice(number, 1, 9), ", "), F.array_join(F.slice(number, 1, 8), ", ")
    k = F.col("vec_id") % 6
    return (
        F.when(k == 0, F.concat(F.lit('[{"label": "b'), "label", F.lit('", "bbox_3d": ['), nine, F.lit("]}]")))
        .when(k == 1, F.concat(F.lit('{"bbox_3d": ['), nine, F.lit("]}")))
        .when(k == 2, F.concat(F.lit("[{'label': 'q', 'bbox_3d': ["), F.array_join(number, ", "), F.lit("]}]")))
        .when(k == 3, F.concat(F.lit('[{"label": "short", "bbox_3d": ['), eight, F.lit("]}]")))
        .when(k == 4, F.lit("no boxes here"))
        .otherwise(F.concat(F.lit('[{"label": "", "bbox_3d": ['), nine, F.lit(']}, {"label": "two", "bbox_3d": ['), nine, F.lit("]}]")))
    )


@query("""
    WITH v AS (SELECT vec_id, label, vec_id % 6 AS k, list_transform(embedding[1:9], lambda x: round(x::DOUBLE * 1000)::DOUBLE + 0.0::DOUBLE) AS b FROM embeddings),
    r AS (
        SELECT vec_id, 0 AS place, CASE k WHEN 0 THEN 'b' || label WHEN 2 THEN 'q' ELSE 'object' END AS name, b FROM v WHERE k IN (0, 1, 2, 5)
        UNION ALL SELECT vec_id, 1, 'two', b FROM v WHERE k = 5)
    SELECT vec_id, place::BIGINT AS place, name, b[1] AS first, b[9] AS last, list_sum(b)::DOUBLE AS total FROM r""")
def box_parse(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    rows = table(spark, sf, "embeddings").select("vec_id", F.posexplode(geom3d.boxes(_box_text())).alias("place", "b"))
    box = F.col("b.bbox_3d")
    total = F.aggregate(box, F.lit(0.0), lambda s, x: s + x)
    return rows.select("vec_id", F.col("place").cast("long").alias("place"), F.col("b.label").alias("name"), F.get(box, 0).alias("first"), F.get(box, 8).alias("last"), total.alias("total"))


@query("""
    WITH v AS (SELECT vec_id, vec_id % 7 AS k, list_transform(embedding[1:9], lambda x: round(x::DOUBLE * 1000)::DOUBLE + 0.0::DOUBLE) AS b FROM embeddings)
    SELECT vec_id, CASE k WHEN 1 THEN 'seen' WHEN 2 THEN 'quoted' WHEN 4 THEN 'good' WHEN 5 THEN 'ten' ELSE 'object' END AS name, b[1] AS first, b[9] AS last FROM v WHERE k <> 3""")
def box_literals(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes in Python literals with None and True, in a lone literal with a tuple beside, with numbers in quotes, in a tuple of boxes, which is no list,
    beside a box with a bad number, before a tenth value that is none, and with a label of 0 beside true and an item that is no object."""
    ship(spark)
    number = F.transform(F.slice("embedding", 1, 9), lambda x: F.round(x.cast("double") * 1000).cast("long").cast("string"))
    nine, quoted = F.array_join(number, ", "), F.array_join(F.transform(number, lambda x: F.concat(F.lit('"'), x, F.lit('"'))), ", ")
    k = F.col("vec_id") % 7
    text = (
        F.when(k == 0, F.concat(F.lit("[{'label': None, 'seen': True, 'bbox_3d': ["), nine, F.lit("]}, None]")))
        .when(k == 1, F.concat(F.lit("{'label': 'seen', 'size': (1, 2), 'bbox_3d': ["), nine, F.lit("]}")))
        .when(k == 2, F.concat(F.lit('[{"label": "quoted", "bbox_3d": ['), quoted, F.lit("]}]")))
        .when(k == 3, F.concat(F.lit("({'label': 'no', 'bbox_3d': ["), nine, F.lit("]},)")))
        .when(k == 4, F.concat(F.lit("[{'label': 'bad', 'bbox_3d': ['x', "), nine, F.lit("]}, {'label': 'good', 'bbox_3d': ["), nine, F.lit("]}]")))
        .when(k == 5, F.concat(F.lit('[{"label": "ten", "bbox_3d": ['), nine, F.lit(', "tenth"]}]')))
        .otherwise(F.concat(F.lit('[{"bbox_3d": ['), nine, F.lit('], "label": 0, "hidden": true}, 3]')))
    )
    rows = table(spark, sf, "embeddings").select("vec_id", F.explode(geom3d.boxes(text)).alias("b"))
    return rows.select("vec_id", F.col("b.label").alias("name"), F.get("b.bbox_3d", 0).alias("first"), F.get("b.bbox_3d", 8).alias("last"))


#: Width, height and angles of the stand-in camera.
_CAM = (256.0, 192.0, 62.26, 48.74)
_BOX_SQL = "SELECT vec_id, e[1] * 4 AS x, e[2] * 4 AS y, e[3] * 8 + 0.5 AS z, abs(e[4]) * 5 + 0.1 AS sx, abs(e[5]) * 5 + 0.1 AS sy, abs(e[6]) * 5 + 0.1 AS sz, e[7] * 3 AS roll, e[8] * 3 AS pitch, e[9] * 3 AS yaw FROM (SELECT vec_id, list_transform(embedding[1:9], lambda x: x::DOUBLE) AS e FROM embeddings)"
_CORNERS_SQL = f"""
    SELECT vec_id, i, x + (cos(yaw) * cos(roll) + sin(yaw) * sin(pitch) * sin(roll)) * lx + (sin(yaw) * sin(pitch) * cos(roll) - cos(yaw) * sin(roll)) * ly + sin(yaw) * cos(pitch) * lz AS cx,
        y + cos(pitch) * sin(roll) * lx + cos(pitch) * cos(roll) * ly - sin(pitch) * lz AS cy,
        z + (cos(yaw) * sin(pitch) * sin(roll) - sin(yaw) * cos(roll)) * lx + (sin(yaw) * sin(roll) + cos(yaw) * sin(pitch) * cos(roll)) * ly + cos(yaw) * cos(pitch) * lz AS cz
    FROM (SELECT *, [-1, 1, 1, -1, -1, 1, 1, -1][i + 1] * sx / 2 AS lx, [-1, -1, 1, 1, -1, -1, 1, 1][i + 1] * sy / 2 AS ly, [-1, -1, -1, -1, 1, 1, 1, 1][i + 1] * sz / 2 AS lz FROM ({_BOX_SQL}), range(8) r(i))"""


def _boxes(spark: SparkSession, sf: str) -> DataFrame:
    e = [F.get("embedding", i).cast("double") for i in range(9)]
    box = F.array(e[0] * 4, e[1] * 4, e[2] * 8 + 0.5, *[F.abs(e[i]) * 5 + 0.1 for i in (3, 4, 5)], *[e[i] * 3 for i in (6, 7, 8)])
    w, h, hfov, vfov = _CAM
    cam = F.struct(F.lit(hfov).alias("hfov"), F.lit(vfov).alias("vfov"), F.lit(w).alias("width"), F.lit(h).alias("height"))
    return table(spark, sf, "embeddings").select("vec_id", box.alias("box"), cam.alias("cam")).withColumn("corners", geom3d.corners(F.col("box")))


def _rounded(c: Column) -> Column:
    return F.round(c, 3) + F.lit(0.0)


@query(f"SELECT vec_id, i AS corner, round(cx, 3) + 0.0 AS x, round(cy, 3) + 0.0 AS y, round(cz, 3) + 0.0 AS z FROM ({_CORNERS_SQL})")
def box_corners(spark: SparkSession, sf: str) -> DataFrame:
    rows = _boxes(spark, sf).select("vec_id", F.posexplode("corners").alias("corner", "c"))
    return rows.select("vec_id", F.col("corner").cast("long").alias("corner"), *[_rounded(F.col(f"c.{k}")).alias(k) for k in "xyz"])


def _project_sql(x: str, y: str, z: str) -> str:
    w, h, hfov, vfov = _CAM
    return f"CASE WHEN {z} > 1e-6 THEN {w}::DOUBLE / 2 / tan(radians({hfov}::DOUBLE) / 2) * ({x} / {z}) + {w}::DOUBLE / 2 END AS u, CASE WHEN {z} > 1e-6 THEN {h}::DOUBLE / 2 / tan(radians({vfov}::DOUBLE) / 2) * ({y} / {z}) + {h}::DOUBLE / 2 END AS v"


@query(f"SELECT vec_id, i AS corner, round(u, 2) + 0.0 AS u, round(v, 2) + 0.0 AS v FROM (SELECT vec_id, i, {_project_sql('cx', 'cy', 'cz')} FROM ({_CORNERS_SQL}))")
def box_project(spark: SparkSession, sf: str) -> DataFrame:
    rows = _boxes(spark, sf).select("vec_id", "cam", F.posexplode("corners").alias("corner", "c"))
    rows = rows.select("vec_id", F.col("corner").cast("long").alias("corner"), geom3d.project(F.col("c"), F.col("cam")).alias("p"))
    return rows.select("vec_id", "corner", *[(F.round(f"p.{k}", 2) + F.lit(0.0)).alias(k) for k in "uv"])


def _cut_sql(k: str, a: int, b: int) -> str:
    """Coordinate k of end a of an edge, moved along it to the near plane if it lies before."""
    t = f"((0.0001::DOUBLE - z{a}) / (z{b} - z{a}))"
    return f"CASE WHEN z{a} >= 0.0001::DOUBLE THEN {k}{a} ELSE " + ("0.0001::DOUBLE" if k == "z" else f"{k}{a} + {t} * ({k}{b} - {k}{a})") + f" END AS {k}{a}"


_SEGMENTS_SQL = f"""
    WITH c AS ({_CORNERS_SQL}),
    e AS (SELECT * FROM (VALUES (0, 0, 1), (1, 1, 2), (2, 2, 3), (3, 3, 0), (4, 4, 5), (5, 5, 6), (6, 6, 7), (7, 7, 4), (8, 0, 4), (9, 1, 5), (10, 2, 6), (11, 3, 7)) t(edge, a, b)),
    s AS (SELECT p.vec_id, e.edge, p.cx AS x0, p.cy AS y0, p.cz AS z0, q.cx AS x1, q.cy AS y1, q.cz AS z1 FROM e JOIN c p ON p.i = e.a JOIN c q ON q.i = e.b AND q.vec_id = p.vec_id),
    k AS (SELECT vec_id, edge, {', '.join(_cut_sql(k, a, 1 - a) for a in (0, 1) for k in 'xyz')} FROM s WHERE z0 >= 0.0001 OR z1 >= 0.0001)
    SELECT vec_id, edge::INTEGER AS edge, {_project_sql('x0', 'y0', 'z0').replace(' AS u', ' AS u0').replace(' AS v', ' AS v0')}, {_project_sql('x1', 'y1', 'z1').replace(' AS u', ' AS u1').replace(' AS v', ' AS v1')} FROM k"""


def _places(*names: str) -> list[Column]:
    return [(F.round(F.col(n), 2) + F.lit(0.0)).alias(n) for n in names]


@query(f"SELECT vec_id, edge, {', '.join(f'round({k}, 2) + 0.0 AS {k}' for k in ('u0', 'v0', 'u1', 'v1'))} FROM ({_SEGMENTS_SQL})")
def box_edges(spark: SparkSession, sf: str) -> DataFrame:
    rows = _boxes(spark, sf).select("vec_id", F.explode(geom3d.edge_segments(F.col("corners"), F.col("cam"))).alias("s"))
    rows = rows.select("vec_id", "s.edge", *[F.col(f"s.{end}.{k}").alias(f"{k}{n}") for n, end in enumerate("ab") for k in "uv"])
    return rows.select("vec_id", "edge", *_places("u0", "v0", "u1", "v1"))


@query(f"""
    WITH f AS (SELECT vec_id, min_by((u0 + u1) / 2, edge) AS u, min_by((v0 + v1) / 2, edge) AS v FROM ({_SEGMENTS_SQL}) GROUP BY vec_id),
    c AS (SELECT vec_id, {_project_sql('x', 'y', 'greatest(z, 0.0001::DOUBLE)')} FROM ({_BOX_SQL}))
    SELECT vec_id, round(coalesce(f.u, c.u), 2) + 0.0 AS u, round(coalesce(f.v, c.v), 2) + 0.0 AS v FROM c LEFT JOIN f USING (vec_id)""")
def box_labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = _boxes(spark, sf).withColumn("segments", geom3d.edge_segments(F.col("corners"), F.col("cam")))
    rows = rows.select("vec_id", geom3d.label_anchor(F.col("segments"), F.col("box"), F.col("cam")).alias("p")).select("vec_id", "p.u", "p.v")
    return rows.select("vec_id", *_places("u", "v"))
