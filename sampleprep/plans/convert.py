"""The whole conversion: source rows to samples, shards and metadata; and the re-scan of what was written."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleprep.functions import binary, classify
from sampleprep.functions import text as t
from sampleprep.operators import nested, recon, shards, stats
from sampleprep.operators import validate as audits
from sampleprep.session import BATCH_BYTES, map_arrow, ship
from sampleprep.sources import ranges
from sampleprep.sources.shards import _open, parse_samples, read_manifest, read_samples, register, write_manifest


def read_source(spark: SparkSession, folder: str, most_rows: int | None = None) -> DataFrame:
    """All Parquet files of a folder, with file_index and row_in_file; the first most_rows rows in file order, by the files' own row counts."""
    read = spark.read.parquet(f"{folder.rstrip('/')}/*.parquet")
    rows = shards.with_file_order(read)
    if most_rows is None:
        return rows
    paths = sorted(read.inputFiles())
    return shards.capped(rows, most_rows, footer_counts(spark, paths) if paths and _reachable(paths[0]) else None)


def _reachable(path: str) -> bool:
    """Whether tasks can open a file without Spark's readers; else its rows are counted by a scan."""
    try:
        system, at = _open(path)
        return system.get_file_info(at).is_file
    except (OSError, ValueError, pa.ArrowInvalid, pa.ArrowNotImplementedError):
        return False


def footer_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file_index (place in paths) and n of Parquet files, read from their footers in tasks; no column is read."""
    files = spark.createDataFrame([(k, p) for k, p in enumerate(paths)], "file_index int, path string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = []
            for path in batch.column("path").to_pylist():
                system, at = _open(path)
                with system.open_input_file(at) as f:
                    counts.append(pq.ParquetFile(f).metadata.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("file_index"), pa.array(counts, pa.int64())], ["file_index", "n"])

    return map_arrow(files.repartition(max(1, min(len(paths), 2000))), run, "file_index int, n long")


def image_count(rows: DataFrame) -> Column:
    """The number of a row's image slots, by a field of the slots that holds no bytes: the size of the whole list would have Spark read the payloads."""
    kind = rows.schema["images"].dataType if "images" in rows.columns else None
    if not isinstance(kind, T.ArrayType):
        return F.lit(0)
    fields = kind.elementType.fields if isinstance(kind.elementType, T.StructType) else []
    narrow = [f.name for f in fields if not isinstance(f.dataType, T.BinaryType) and f.name != "bytes"]
    return F.coalesce(F.size(F.col("images").getField(narrow[0]) if narrow else F.col("images")), F.lit(0))


def prepare(rows: DataFrame) -> DataFrame:
    """Adds ordinal, sample_id, source, n_images, category_field, category and valid; reads no payload of slots that have another field.

    Whether a row is converted depends on its turns alone, so all that is counted comes from narrow columns.
    """
    turns = F.col("conversations")
    n_images = image_count(rows)
    column = lambda name: F.col(name).cast("string") if name in rows.columns else F.lit(None).cast("string")
    ordinal = t.row_ordinal(F.col("file_index"), F.col("row_in_file"))
    inferred = classify.infer_category(t.first_human_text(turns), n_images)
    field, value = classify.resolve_category(rows.columns, column("meta_info") if "meta_info" in rows.columns else None, inferred)
    return rows.withColumns(
        {
            "ordinal_": ordinal, "sample_id": t.sample_id(column("data_source"), column("id"), ordinal), "source": t.normalise_source(column("data_source")),
            "n_images": n_images, "category_field": field, "category_": value, "valid": nested.is_valid(turns),
        }
    )


def slot_payloads(rows: DataFrame) -> Column:
    """Array of the payloads of a row's slots in order, null where a slot doesn't decode; empty without a list of images."""
    kind = rows.schema["images"].dataType if "images" in rows.columns else None
    if not isinstance(kind, T.ArrayType):
        return F.array().cast("array<binary>")
    return F.transform(F.coalesce("images", F.array().cast(kind)), lambda x: binary.payload(x, kind.elementType))


def build_samples(prepared: DataFrame, encode: binary.Encoder | None = None) -> DataFrame:
    """file_index, row_in_file, source, sample and members (name, payload) of the valid rows; images are named by their place in the source.

    All is worked out inside the row: the one Python step sees the JPEGs, and what only encode can take, in Arrow batches.
    """
    ship(prepared.sparkSession)
    prepared.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    rows = prepared.where("valid").withColumn("payloads_", slot_payloads(prepared))
    rows = rows.withColumn("encoded_", binary.encoded(F.col("payloads_"), encode))

    def named(e: Column, i: Column) -> Column:
        path = t.member_name(F.col("sample_id"), i, e["format"])
        image = F.struct(path.alias("relative_path"), *[e[k].alias(k) for k in ("format", "width", "height")])
        return F.when(e.isNotNull(), F.struct(image.alias("image"), F.struct(path.alias("name"), e["payload"].alias("payload")).alias("member")))

    rows = rows.withColumn("all_", F.array_compact(F.transform("encoded_", named)))
    images, members = F.transform("all_", lambda x: x["image"]), F.transform("all_", lambda x: x["member"])
    return rows.select("file_index", "row_in_file", "source", nested.sample(F.col("conversations"), images, F.col("sample_id"), F.col("category_")).alias("sample"), members.alias("members"))


def write_shards(samples: DataFrame, root: str, shard_size: int = 8192, emit_trailing_empty: bool = True) -> DataFrame:
    """Write samples in the order of their rows, in place of what shards root has; gives the shards' counts.

    Where each shard begins in each file comes from (file_index, row_in_file) alone. With that at hand, samples and payloads
    move once: to their shards' tasks, sorted there.
    """
    register(samples.sparkSession)
    earlier = read_manifest(root.rstrip("/"))
    write_manifest(root.rstrip("/"), earlier["shards"] if earlier else [], False)  # until the commit
    laid = shards.segments(samples, "file_index", "row_in_file", shard_size).persist()
    counts = laid.groupBy("shard_id").agg(F.sum("n").alias("n"))
    counts = shards.with_trailing(counts, shard_size) if emit_trailing_empty else counts
    placed = shards.place(samples, laid, "file_index", "row_in_file", shard_size)
    lines = placed.select("shard_id", "file_index", F.col("row_in_file").cast("long").alias("row_in_file"), F.to_json("sample").alias("line"), "members")
    empty = {"file_index": F.lit(0), "row_in_file": F.lit(0).cast("long"), "line": F.lit(None).cast("string"), "members": F.lit(None).cast(lines.schema["members"].dataType)}
    trailing = counts.where("n = 0").select("shard_id", *[c.alias(k) for k, c in empty.items()])
    rows = lines.unionByName(trailing).repartition("shard_id").sortWithinPartitions("shard_id", "file_index", "row_in_file").select("shard_id", "line", "members")
    rows.write.format("tarshards").mode("overwrite").save(root)
    laid.unpersist()
    return counts


def metadata(prepared: DataFrame, samples: DataFrame, requested: int | None = None, total_rows: int | None = None) -> dict[str, Any]:
    """Counts and distributions over all rows seen, geometry over the images of samples (id, data) that were converted.

    The source is classified once: what is asked of it comes from its counts by category, source and number of images.
    """
    grouped = prepared.groupBy(F.col("category_").alias("category"), "source", "n_images")
    grouped = grouped.agg(F.count("*").alias("n"), F.count_if("valid").alias("valid"), F.min(F.struct("ordinal_", "category_field")).alias("first")).persist()
    seen = grouped.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("seen"), F.coalesce(F.sum("valid"), F.lit(0)).alias("converted"), F.min("first").alias("first")).first()
    field = seen["first"].category_field if seen["first"] is not None else None
    dists: dict[str, dict] = {"category": {}, "source": {}, "n_images": {}}
    # one row for each category, source and image count
    for r in stats.distributions(grouped, *dists, weight="n").collect():
        dists[r.dimension][r.key] = {"count": r.n, "ratio": r.ratio}
    grouped.unpersist()
    stopped = requested is not None and seen.seen >= requested and total_rows is not None and total_rows > requested
    return {
        "dataset_total_samples": None if stopped else seen.seen,
        "stopped_by_max_samples": stopped,
        "requested_max_samples": requested,
        "id_strategy": "source_plus_id",
        "image_placeholder_policy": "always_strip",
        "image_naming_policy": "flat_global",
        "total_samples_seen": seen.seen,
        "converted_samples": seen.converted,
        "skipped_samples": seen.seen - seen.converted,
        "category_field_detected": field,
        "has_category": bool(dists["category"]),
        "category_distribution": dists["category"],
        "data_source_distribution": dists["source"],
        "image_count_distribution": dict(sorted(dists["n_images"].items(), key=lambda kv: int(kv[0]))),
        "resolution_stats": resolution_stats(samples),
    }


def sample_images(samples: DataFrame, normalise: Callable[[Column], Column] = t.normalise_source, *others: str) -> DataFrame:
    """source, width, height (and the columns others) of each image of the first user turns; the source as the id has it, normalised."""
    rows = samples.select(*others, normalise(t.source_of_id(F.coalesce("id", F.lit("")))).alias("source"), F.explode(nested.first_user_images(F.col("data"))).alias("i"))
    return rows.select(*others, "source", F.coalesce("i.width", F.lit(-1)).alias("width"), F.coalesce("i.height", F.lit(-1)).alias("height"))


def resolution_stats(samples: DataFrame, normalise: Callable[[Column], Column] = t.normalise_source) -> dict[str, Any]:
    """The geometry document: one aggregate over all images, of which a row for each source and bucket reaches the driver."""
    return geometry_document(stats.geometry(sample_images(samples, normalise)))


def geometry_document(geometry: DataFrame) -> dict[str, Any]:
    """The document of what stats.geometry or stats.merge_geometry gives."""
    found = geometry.orderBy(F.desc("n"), "bucket").collect()

    def block(scope: str | None) -> dict[str, Any]:
        total = next(r for r in found if r.scope == scope and r.kind == "total")
        share = lambda n: round(n / max(1, total.n), 6)
        dist = {k: {r.bucket: {"count": r.n, "ratio": share(r.n)} for r in found if r.scope == scope and r.kind == k} for k in ("megapixel", "short_edge")}
        sizes = {} if scope is None else {f"{a}_{b}": total[f"{a}_{b}"] for a in ("width", "height") for b in ("min", "max")}
        return {"total_images": total.n, "unknown_geometry": total.unknown, **sizes, "megapixel_bucket_distribution": dist["megapixel"], "short_edge_bucket_distribution": dist["short_edge"]}

    whole = block(None) if any(r.scope is None and r.kind == "total" for r in found) else {"total_images": 0, "unknown_geometry": 0, "megapixel_bucket_distribution": {}, "short_edge_bucket_distribution": {}}
    orders = {"megapixel_bucket_order": stats.bucket_order(stats.MEGAPIXELS), "short_edge_bucket_order": stats.bucket_order(stats.SHORT_EDGES)}
    sources = sorted(r.scope for r in found if r.scope is not None and r.kind == "total")
    return {"schema_version": 1, **whole, **orders, "by_data_source": {s: block(s) for s in sources}}


def read_metadata(root: str) -> dict[str, Any]:
    """The metadata document; empty if it is missing or broken."""
    system, at = _open(root.rstrip("/"))
    try:
        with system.open_input_file(f"{at}/metadata.json") as f:
            made = json.loads(f.read())
    except (OSError, ValueError):
        return {}
    return made if isinstance(made, dict) else {}


def write_metadata(root: str, document: dict[str, Any]) -> None:
    system, at = _open(root.rstrip("/"))
    with system.open_output_stream(f"{at}/metadata.json") as f:
        f.write(json.dumps(document, ensure_ascii=False, indent=2).encode())


def convert(
    spark: SparkSession, source: str, root: str, shard_size: int = 8192, most_rows: int | None = None, encode: binary.Encoder | None = None, dataset_name: str | None = None
) -> dict[str, Any]:
    """Source folder to shards and metadata.json under root; gives the metadata. The geometry is that of the written samples."""
    if shard_size <= 0:
        raise ValueError("shard_size must be positive")
    prepared = prepare(read_source(spark, source, most_rows))
    write_shards(build_samples(prepared, encode), root, shard_size)
    rows = spark.read.parquet(f"{source.rstrip('/')}/*.parquet")
    total = rows.count() if most_rows is not None else None
    head = {"dataset_name": dataset_name, "input_parquet_dir": source, "output_root": root, "workers": spark.sparkContext.defaultParallelism, "parquet_files_scheduled": len(rows.inputFiles())}
    document = {**head, **metadata(prepared, read_samples(spark, root), most_rows, total)}
    write_metadata(root, document)
    return document


def with_readable(spark: SparkSession, root: str, members: DataFrame, references: DataFrame, decodes: Callable[[bytes], bool] | None = None) -> DataFrame:
    """members (of ranges.last_members) with readable: of those that references (path) name the payloads are fetched and checked, the others' are not read."""
    named = references.select(F.col("path").alias("name")).distinct()
    fetched = ranges.fetch_members(spark, root, members.where("size > 0").join(named, "name", "left_semi"))
    checked = fetched.select("name", F.coalesce(binary.readable(F.col("payload"), decodes), F.lit(False)).alias("readable"))
    return members.join(checked, "name", "left").select("shard_id", "name", "size", F.coalesce("readable", F.lit(False)).alias("readable"))


def rescan(spark: SparkSession, root: str, validate: bool = True, most_lines: int | None = None, decodes: Callable[[bytes], bool] | None = None) -> dict[str, Any]:
    """Recount the geometry of written samples, check their images, and put both into metadata.json.

    most_lines caps the lines of each shard; decodes is a full decode of an image, in place of the check of its header.
    """
    samples = read_samples(spark, root, most_lines=most_lines)
    document = read_metadata(root) | {"resolution_stats": resolution_stats(samples)}
    if validate:
        members = ranges.last_members(ranges.member_index(spark, root)).persist()
        references = samples.select(F.explode(nested.image_paths(F.col("data"))).alias("path"))
        found = recon.check_references(references, with_readable(spark, root, members, references, decodes)).first()
        # fixed keys of the document; tar_cache_size has no meaning here, as no archive is kept open
        document["image_read_validation"] = {
            "images_checked": found.checked, "abnormal_images": found.abnormal, "missing_in_tar": found.missing, "empty_tar_payload": found.empty, "pil_decode_failed": found.unreadable,
            "tar_members_indexed": members.count(), "tar_cache_size": 0, "workers_effective": spark.sparkContext.defaultParallelism,
        }
        members.unpersist()
    write_metadata(root, document)
    return document


def census(spark: SparkSession, source: str, validate: bool = True, decodes: Callable[[bytes], bool] | None = None) -> dict[str, Any]:
    """The census of the source's image slots as a document; of the rows only counts by shape and by number of slots reach the driver."""
    rows = spark.read.parquet(f"{source.rstrip('/')}/*.parquet")
    kind = rows.schema["images"].dataType if "images" in rows.columns else T.NullType()
    slots, shape = binary.image_shape(F.col("images") if "images" in rows.columns else F.lit(None), kind)
    counted = rows.select(slots.alias("slots"), shape.alias("shape"))
    found = stats.census(counted).orderBy(F.desc("rows"), "shape").collect()
    whole = next((r for r in found if r.overall), None)
    shapes = [r for r in found if not r.overall]
    document = {
        "parquet_dir": source,
        "parquet_file_count": len(rows.inputFiles()),
        "parquet_total_rows_metadata": whole.rows if whole else 0,
        "total_rows_scanned": whole.rows if whole else 0,
        "total_source_images": whole.slots if whole else 0,
        "rows_images_unsupported_or_empty": whole.without_slots if whole else 0,
        "workers_effective": spark.sparkContext.defaultParallelism,
        "avg_images_per_row": whole.average if whole else 0.0,
        "images_per_row_histogram": {str(r.slots): r.n for r in stats.slot_histogram(counted).orderBy("slots").collect()},
        "rows_by_images_shape": {r["shape"]: r["rows"] for r in shapes},
        "image_slots_by_images_shape": {r["shape"]: r["slots"] for r in sorted(shapes, key=lambda r: -r["slots"])},
    }
    if validate:
        ship(spark)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        one = isinstance(kind, T.StringType)
        decoded = F.array(binary.payload(F.col("images"), kind)) if one else slot_payloads(rows)
        held = rows.where(slots > 0).select(F.explode(decoded).alias("decoded"))
        checked = stats.slot_validity(held.select("decoded", binary.readable(F.col("decoded"), decodes).alias("readable"))).first()
        document["image_bytes_validation"] = {"slots_pil_ok": checked.ok, "slots_decode_failed": checked.decode_failed, "slots_pil_invalid": checked.invalid, "slots_checked": checked.checked}
    return document


def shard_ranges(samples: DataFrame) -> DataFrame:
    """shard_id, n, start, end of written samples, for pages and look-ups by ordinal."""
    return shards.prefix_sums(samples.groupBy("shard_id").agg(F.count("*").alias("n")), "shard_id", "n")


def browse(samples: DataFrame, **wanted: str) -> DataFrame:
    """Samples that meet the browser's filter; for shards.filtered_page()."""
    return samples.where(nested.matches(F.col("id"), F.col("category"), F.col("data"), **wanted))


def validate_dataset(spark: SparkSession, root: str, multiple: int = 16) -> DataFrame:
    """A row for each shard of a written dataset with the counts of its checks, from one pass over pairs of line file and archive.

    has_text and has_archive (the pair is there), n (lines that hold an object), broken (other lines), bad_keys, bad_roles, bad_assistant,
    bad_user, unresolved (paths that the shard's archive lacks), members, unreferenced (members that no line names), size_ok.
    """
    scanned = ranges.scan_pairs(spark, root)
    rows = parse_samples(scanned, "shard_id", "line_idx", "unresolved", "has_text", "has_archive", "members", "unreferenced", keep=True)
    checked = audits.check_samples(rows, "shard_id", "line_idx", "unresolved", "has_text", "has_archive", "members", "unreferenced")
    line = F.col("line_idx").isNotNull()
    held = line & F.col("unresolved").isNotNull()
    bad = lambda ok: F.count_if(held & ~F.col(ok))
    counted = checked.groupBy("shard_id").agg(
        F.coalesce(F.bool_or("has_text"), F.lit(False)).alias("has_text"),
        F.coalesce(F.bool_or("has_archive"), F.lit(False)).alias("has_archive"),
        F.count_if(held).alias("n"),
        F.count_if(line & ~held).alias("broken"),
        *[bad(f"{k}_ok").alias(f"bad_{k}") for k in ("keys", "roles", "assistant", "user")],
        F.coalesce(F.sum(F.size("unresolved")), F.lit(0)).alias("unresolved"),
        F.coalesce(F.sum("members"), F.lit(0)).alias("members"),
        F.coalesce(F.sum("unreferenced"), F.lit(0)).alias("unreferenced"),
    )
    sizes = audits.shard_sizes(counted.select("shard_id", "n"), multiple).drop("n")
    return counted.join(sizes, "shard_id")
