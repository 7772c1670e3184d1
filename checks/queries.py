"""One registered query per operator, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate import fixtures
from batchgate import schema as S
from batchgate.fixtures import AS_OF, FIXTURE_MAX_BYTES
from batchgate.operators import batch as B
from batchgate.operators import gate as G
from batchgate.operators import rows as R
from batchgate.operators import workload as W
from batchgate.operators.ids import id_counts, raw_ids
from batchgate.operators.linkage import link_refunds
from batchgate.operators.reconcile import manifest_reconcile
from batchgate.plans import bench_workload, process_incoming
from batchgate.session import materialise, scratch_root, spread_files
from batchgate.sinks import (
    expired_batches,
    processed_batches,
    remove_batches,
    write_csv,
    write_manifest,
    write_summaries,
    write_transactions,
)
from batchgate.sinks import versions as V
from batchgate.sources import (
    explode_events,
    list_incoming,
    profile_files,
    read_all_strings,
    read_manifest,
)
from batchgate.sources import csv_files as C
from batchgate.sources.csv_files import utf8_gate
from batchgate.sources.incoming import qualified_uri
from batchgate.streaming import stream_versions
from batchgate.synth import clean_rows, inject_defects
from batchgate.synth.datasets import relink

SEED = 42
DEFECT_RATE = 0.05
ORDERS_PER_FILE = 5000

Query = Callable[[SparkSession, str], DataFrame]


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.landed_transactions(spark, sf_dir)


def _validated(spark: SparkSession, sf_dir: str) -> B.ValidatedBatch:
    return B.validate_batch(_rows(spark, sf_dir), AS_OF)


# --- rows ------------------------------------------------------------------


def structural_violations(spark, sf_dir):
    checked = R.check_rows(_rows(spark, sf_dir), AS_OF)
    return checked.where(~F.col("ok")).select(
        "source_key",
        "row_seq",
        R.result_id().alias("transaction_id"),
        F.posexplode(R.structural_violations()).alias("pos", "v"),
    ).select("source_key", "row_seq", "pos", "transaction_id", "v.rule", "v.severity", "v.detail")


def row_rule(name: str, spark, sf_dir):
    rule = next(r for r in R.ROW_RULES if r.name == name)
    checked = R.check_rows(_rows(spark, sf_dir), AS_OF)
    detail = rule.detail(R.as_of_column(AS_OF))
    return checked.where(F.col("ok") & detail.isNotNull()).select(
        "source_key", "row_seq", F.lit(rule.severity).alias("severity"), detail.alias("detail")
    )


def rule_duplicate(spark, sf_dir):
    rows = _validated(spark, sf_dir).rows
    return rows.where(F.col("same_id") > 1).select(
        "source_key",
        "row_seq",
        F.lit(S.CRITICAL).alias("severity"),
        B.duplicate_detail().alias("detail"),
    )


def rule_orphaned_refund(spark, sf_dir):
    rows = _validated(spark, sf_dir).rows
    return rows.where("orphan").select(
        "source_key",
        "row_seq",
        "transaction_id",
        F.lit(S.CRITICAL).alias("severity"),
        B.orphan_detail(F.col("related_transaction_id")).alias("detail"),
    )


def row_dispositions(spark, sf_dir):
    return _validated(spark, sf_dir).rows.select(
        "source_key", "row_seq", "ok", "critical", "flagged", "same_id"
    )


def batch_summary_by_rule(spark, sf_dir):
    long = _validated(spark, sf_dir).exceptions_long()
    return long.groupBy("source_key", "rule", "severity").agg(
        F.count(F.lit(1)).alias("violations")
    )


# --- four-stage workload ---------------------------------------------------


def _flagged(spark, sf_dir):
    return W.bench_validate(W.bench_parse(_rows(spark, sf_dir)), AS_OF)


def bench_parse(spark, sf_dir):
    return W.bench_parse(_rows(spark, sf_dir)).select(
        "row_seq", "amount_parsed", "transaction_date_parsed", "posted_date_parsed"
    )


def _with_ids(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    return W.attach_whole_input(rows, W.bench_ids(rows))


def bench_dup_counts(spark, sf_dir):
    return _with_ids(spark, sf_dir).select("row_seq", F.col("same_id").alias("id_count"))


def bench_orphans(spark, sf_dir):
    return _with_ids(spark, sf_dir).where("orphan").select("row_seq", "transaction_id")


# --- files -----------------------------------------------------------------


def _gated(spark, sf_dir):
    listing = fixtures.landed_listing(spark, sf_dir).withColumn("bucket", F.lit("bucket"))
    return G.gate_files(listing, AS_OF, FIXTURE_MAX_BYTES)


def _files(spark, sf_dir):
    return G.mark_within_run(_gated(spark, sf_dir))


def file_gate(spark, sf_dir):
    return _gated(spark, sf_dir).select(
        "arrival_seq", "source_key", "file_date", "partner_batch_id", "disposition", "reason"
    )


def file_staleness(spark, sf_dir):
    files = _gated(spark, sf_dir)
    return files.where(F.col("staleness").isNotNull()).select("arrival_seq", "staleness")


def file_reprocessing(spark, sf_dir):
    return _files(spark, sf_dir).where(F.col("reprocessing") | F.col("superseded")).select(
        "arrival_seq", "partner_batch_id", "already_processed", "reprocessing", "superseded"
    )


def file_dispositions(spark, sf_dir):
    files = _gated(spark, sf_dir)
    side = (
        F.when(~F.col("admitted"), None)
        .when(F.col("staleness").endswith("past"), "past")
        .when(F.col("staleness").endswith("future"), "future")
        .otherwise("fresh")
    )
    return files.groupBy("disposition", side.alias("freshness"), "already_processed").agg(
        F.count(F.lit(1)).alias("files")
    )


def event_explode(spark, sf_dir):
    """Notification events of up to three files each, sizes left out now and then."""
    d = F.col("arrival_seq")
    listing = fixtures.landed_listing(spark, sf_dir)
    size = F.when(d % 5 != 0, F.concat(F.lit(',"size":'), F.col("size_bytes").cast("string")))
    record = F.concat(
        F.lit('{"s3":{"bucket":{"name":"bucket"},"object":{"key":"'),
        F.col("source_key"),
        F.lit('"'),
        F.coalesce(size, F.lit("")),
        F.lit("}}}"),
    )
    events = listing.groupBy(F.floor(d / 3).alias("event")).agg(
        F.concat(
            F.lit('{"Records":['),
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(d, record.alias("r")))), lambda r: r["r"]), ","),
            F.lit("]}"),
        ).alias("event_json")
    )
    return explode_events(events).select(
        (F.col("event") * 3 + F.col("position")).alias("arrival_seq"),
        "bucket",
        "source_key",
        "size_bytes",
    )


def retention_expired(spark, sf_dir):
    d = F.col("doc_id")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    batches = documents.select(
        F.concat(F.lit("BATCH-"), d.cast("string")).alias("partner_batch_id"),
        F.date_sub(F.lit(AS_OF).cast("date"), (d % 200).cast("int"))
        .cast("timestamp")
        .alias("finished_at"),
    )
    return expired_batches(batches, AS_OF).select("partner_batch_id", "age_days")


# --- samples ---------------------------------------------------------------


def refund_link(spark, sf_dir):
    linked = link_refunds(_rows(spark, sf_dir), SEED)
    return linked.where(F.col("transaction_type") == "refund").select(
        "source_key", "row_seq", "transaction_id", "related_transaction_id"
    )


def _clean(spark, sf_dir):
    """A clean transaction for every order, 5000 orders to a file."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    numbers = orders.select((F.col("o_orderkey") + 1).alias("row_index"))
    batch = F.concat(
        F.lit("B"), F.floor((F.col("row_index") - 1) / ORDERS_PER_FILE).cast("string")
    )
    return clean_rows(numbers, batch, fixtures.FILE_DAY, SEED)


def _linked(spark, sf_dir):
    return link_refunds(materialise(_clean(spark, sf_dir), "clean").df, SEED)


def _defective(spark, sf_dir):
    landed = materialise(_linked(spark, sf_dir), "linked").df
    return inject_defects(landed, DEFECT_RATE, SEED)


def _seeded(spark, sf_dir):
    rows, manifest = _defective(spark, sf_dir)
    return relink(materialise(rows, "defective").df, SEED), manifest


def _plain(df: DataFrame, *extra: str) -> DataFrame:
    return df.select("source_key", "row_seq", *extra, *S.TRANSACTION_COLUMNS)


def defect_manifest(spark, sf_dir):
    """Written as the generator leaves it, and read back."""
    path = f"{scratch_root(spark)}/manifest-{uuid.uuid4().hex}"
    write_manifest(_defective(spark, sf_dir)[1], path)
    return read_manifest(spark, path)


def reconcile(spark, sf_dir):
    rows, manifest = _seeded(spark, sf_dir)
    # Copies get positions of their own.
    numbered = rows.withColumn("row_seq", F.col("row_seq") * 2 + F.col("is_copy").cast("int"))
    landed = materialise(numbered.drop("is_copy"), "seeded").df
    return manifest_reconcile(manifest, B.validate_batch(landed, AS_OF).exceptions_long())


# --- sinks -----------------------------------------------------------------


def _counted_files(validated: B.ValidatedBatch) -> DataFrame:
    return materialise(validated.summary(), "counts").df


def processed_transactions(spark, sf_dir):
    validated = _validated(spark, sf_dir)
    out = f"{scratch_root(spark)}/processed-rows-{uuid.uuid4().hex}"
    write_transactions(validated.valid_rows(), _counted_files(validated), out)
    back = read_all_strings(spark, out, _partitioned_schema())
    return back.where(F.col("object") == "transactions.csv").select(
        "batch", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in S.TRANSACTION_COLUMNS]
    )


def _partitioned_schema() -> str:
    return ", ".join(f"{c} string" for c in [*S.TRANSACTION_COLUMNS, "batch", "object"])


def processed_summaries(spark, sf_dir):
    validated = _validated(spark, sf_dir)
    out = f"{scratch_root(spark)}/processed-docs-{uuid.uuid4().hex}"
    write_summaries(
        _counted_files(validated),
        validated.exceptions(),
        validated.shared_violations(),
        out,
        F.lit("2024-02-15T00:00:00+00:00"),
    )
    document = (
        "partner_batch_id string, source_key string, processed_at string, "
        "counts struct<total_rows:bigint,passed:bigint,rejected_critical:bigint,"
        "flagged_warning_only:bigint>, "
        f"exceptions array<struct<transaction_id:string,violations:{S.VIOLATIONS_DDL},shared:boolean>>, "
        "shared_violations array<struct<transaction_id:string,row_seq:bigint,rule:string,"
        "severity:string,detail:string>>"
    )
    text = spark.read.text(out, wholetext=True)
    return text.where(F.col("object") == "summary.json").select(
        "batch",
        F.to_json(F.from_json("value", document), {"ignoreNullFields": "false"}).alias("document"),
    )


AGAIN = 3  # Files whose number leaves 1 over this arrive a second time.


def _second(rows: DataFrame) -> DataFrame:
    number = F.floor(F.col("row_seq") / fixtures.ROWS_PER_FILE)
    return rows.where(number % AGAIN == 1).withColumn(
        "merchant_name", F.concat(F.lit("Second "), "merchant_name")
    )


def _published(spark, sf_dir) -> str:
    """Every file published once, then a third of them again with other merchants."""
    out = f"{scratch_root(spark)}/versions-{uuid.uuid4().hex}"
    rows = _rows(spark, sf_dir)
    second = _second(rows)
    for run_id, some in (("first", rows), ("second", second)):
        checked = B.validate_batch(some, AS_OF)
        files = checked.summary().withColumn("partner_batch_id", G.parse_filename(F.col("source_key"))[1])
        V.publish(
            spark, out, run_id, materialise(files, "counts").df, checked.valid_rows(),
            checked.exceptions(), checked.shared_violations(), F.lit("2024-02-15T00:00:00+00:00"),
        )
    return out


def versioned_transactions(spark, sf_dir):
    back = V.read_transactions(spark, _published(spark, sf_dir), S.TRANSACTION_COLUMNS)
    run = F.element_at(F.split("version", "-"), 1).alias("run")
    return back.select(
        "batch", run, *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in S.TRANSACTION_COLUMNS]
    )


def versioned_summaries(spark, sf_dir):
    back = V.read_summaries(spark, _published(spark, sf_dir))
    head = "partner_batch_id string, counts struct<total_rows:bigint,passed:bigint>"
    said = back.select("batch", "version", F.from_json("value", head).alias("d"))
    return said.select(
        "batch", F.element_at(F.split("version", "-"), 1).alias("run"),
        F.col("d.counts.total_rows").alias("total_rows"), F.col("d.counts.passed").alias("passed"),
    )


def reprocessing_by_index(spark, sf_dir):
    """The listing against an index of the batches of some of its files."""
    out = f"{scratch_root(spark)}/index-{uuid.uuid4().hex}"
    files = _gated(spark, sf_dir).drop("already_processed")
    early = files.where("arrival_seq % 17 = 2 AND partner_batch_id IS NOT NULL")
    for run_id, some in (("odd", early.where("arrival_seq % 2 = 1")), ("even", early.where("arrival_seq % 2 = 0"))):
        pointers = some.select(
            "partner_batch_id", F.lit(run_id).alias("version"), "source_key",
            F.lit(AS_OF).cast("timestamp").alias("finished_at"),
        )
        V.commit(spark, out, run_id, pointers, compact_after=1)
    marked = G.mark_already_processed(files, V.current(spark, out, files))
    return marked.select("arrival_seq", "partner_batch_id", "already_processed")


def retired_batches(spark, sf_dir):
    """What is left of the published batches once a fifth are retired and swept."""
    out = _published(spark, sf_dir)
    number = F.regexp_extract("partner_batch_id", r"(\d+)$", 1).cast("int")
    V.retire(spark, out, "retire", V.current(spark, out).where(number % 5 == 0))
    V.sweep(spark, out)
    kept = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{out}/data")
    return kept.select(
        F.regexp_extract("path", "/version=(first|second)-", 1).alias("run"),
        F.regexp_extract("path", "/batch=([^/]+)/", 1).alias("batch"),
    ).where("batch <> ''").distinct()


def workload_counts(spark, sf_dir):
    """The four-stage workload over files, as it reports: one line per type and one for all."""
    path = f"{scratch_root(spark)}/workload-{uuid.uuid4().hex}"
    write_csv(_rows(spark, sf_dir), path)
    found = bench_workload(spark, path, AS_OF)
    lines = [("type " + k, n) for k, n in found.pop("by_transaction_type").items()]
    return spark.createDataFrame([*lines, *found.items()], "name string, n bigint")


def _bucket(spark, keyed: DataFrame, fmt: str, root: str | None = None, **options) -> str:
    """A bucket folder with one arriving file per ``key`` of ``keyed``; in ``root`` they replace others."""
    root = root or f"{scratch_root(spark)}/bucket-{uuid.uuid4().hex}"
    written = f"written-{uuid.uuid4().hex}"
    keyed.write.partitionBy("key").options(**options).format(fmt).save(f"{root}/{written}")
    # Spark names its own files; tasks give each the name it should arrive under.
    uri = qualified_uri(spark, root)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(uri)
        files.create_dir(f"{base}/incoming")
        for batch in batches:
            for key in batch.column(0).to_pylist():
                name = key.split("/")[1].removeprefix("key=")
                files.move(f"{base}/{key}", f"{base}/incoming/{name}")
            yield pa.RecordBatch.from_pydict({"moved": pa.array([batch.num_rows], pa.int64())})

    parts = list_incoming(spark, root, prefix=f"{written}/", suffix="").select("source_key")
    parts = parts.where(F.col("source_key").rlike(f"^{written}/key=[^/]+/part-"))
    parts = spread_files(parts, parts.count(), "source_key")
    parts.mapInArrow(move, "moved long").agg(F.sum("moved")).collect()
    return root


def _by_key(keyed: DataFrame) -> DataFrame:
    """Rows of a file together, as many tasks as the files call for."""
    return spread_files(keyed, keyed.select("key").distinct().count(), "key")


def _landed_bucket(spark, sf_dir) -> str:
    return _land(spark, _rows(spark, sf_dir))


def _land(spark, rows: DataFrame, root: str | None = None) -> str:
    rows = rows.withColumn("key", G.file_name(F.col("source_key")))
    keyed = _by_key(rows).sortWithinPartitions("key", "row_seq")
    keyed = keyed.select("key", *S.TRANSACTION_COLUMNS)
    return _bucket(spark, keyed, "csv", root, header="true", emptyValue="")


def utf8_rejects(spark, sf_dir):
    """Document texts, 20 to a file, some with a byte that is not UTF-8."""
    d = F.col("doc_id")
    stray = F.unhex(F.lit("E9")).cast("string")
    text = F.when(d % 7 == 3, F.replace(F.col("text"), F.lit("é"), stray)).otherwise(F.col("text"))
    file = F.floor(d / 20).cast("string")
    name = F.concat(F.lit("transactions_2024-02-14_D"), file, F.lit(".csv"))
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    keyed = documents.select(name.alias("key"), text.alias("value"))
    root = _bucket(spark, _by_key(keyed), "text")
    return utf8_gate(profile_files(spark, root))


def quoted_records(spark, sf_dir):
    """Document texts as quoted fields with line breaks, 100 to a file."""
    d = F.col("doc_id")
    name = F.concat(F.lit("transactions_2024-02-14_Q"), F.floor(d / 100).cast("string"), F.lit(".csv"))
    values = {c: F.lit("") for c in S.TRANSACTION_COLUMNS}
    values |= {"transaction_id": d.cast("string"), "merchant_name": F.col("text")}
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    keyed = documents.select(name.alias("key"), *[v.alias(c) for c, v in values.items()])
    root = _bucket(
        spark, _by_key(keyed), "csv", header="true", escape='"', emptyValue="", nullValue="",
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
    )
    profile = materialise(profile_files(spark, root, max_bytes=1 << 40), "profile").df
    records = C.read_records(spark, root, profile, max_bytes=1 << 40)
    layouts = C.find_layouts(spark, profile, records=records)
    rows = C.read_batch_csv(spark, root, layouts, max_bytes=1 << 40, records=records)
    return rows.select("source_key", "transaction_id", "merchant_name")


def _announced(spark, sf_dir):
    """Notifications of every landed file, of misnamed and huge ones, and of objects that are gone."""
    keys = _rows(spark, sf_dir).groupBy("source_key").agg((F.min("row_seq") / 500).cast("bigint").alias("b"))
    b, key = F.col("b"), F.col("source_key")
    batch = F.regexp_replace(key, "BATCH-", "GONE-")
    def announced(condition, name, size: int):
        return F.when(condition, F.struct(name.alias("k"), F.lit(size).cast("bigint").alias("size")))

    some = F.array(
        announced(F.lit(True), key, 100),
        announced(b % 3 == 0, batch, 0),
        announced(b % 3 == 1, F.regexp_replace(key, "BATCH-", "LOST-"), 7),
        announced(b % 5 == 2, F.concat(F.lit("incoming/no_date_"), b.cast("string"), F.lit(".csv")), 7),
        announced(b % 5 == 3, F.regexp_replace(key, "BATCH-", "HUGE-"), 1 << 40),
    )
    found = keys.select(F.explode(F.array_compact(some)).alias("f")).select(
        F.lit("bucket").alias("bucket"), F.col("f.k").alias("source_key"), F.col("f.size").alias("size_bytes")
    )
    return found.withColumn("arrival_seq", F.col("source_key"))


def pipeline_dispositions(spark, sf_dir):
    root = _landed_bucket(spark, sf_dir)
    run = process_incoming(
        spark, root, as_of=AS_OF, files=_announced(spark, sf_dir), versioned=True
    )
    return run.files.select("source_key", "disposition", "reason", *B.COUNTS)


def pipeline_files(spark, sf_dir):
    run = process_incoming(spark, _landed_bucket(spark, sf_dir), as_of=AS_OF)
    return run.files.select("source_key", "disposition", "staleness", *B.COUNTS)


def pipeline_transactions(spark, sf_dir):
    run = process_incoming(spark, _landed_bucket(spark, sf_dir), as_of=AS_OF)
    return _processed_rows(spark, run.processed)


def _processed_rows(spark, processed: str) -> DataFrame:
    back = read_all_strings(spark, processed, _partitioned_schema())
    return back.where(F.col("object") == "transactions.csv").select(
        "batch", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in S.TRANSACTION_COLUMNS]
    )


def streamed_transactions(spark, sf_dir):
    """Every file by the stream of versions, then a third of them replaced in place, and once more."""
    rows = _rows(spark, sf_dir)
    root = _land(spark, rows)
    for replaced in (None, _second(rows), None):
        if replaced is not None:
            _land(spark, replaced, root)
        query = stream_versions(spark, root, f"{root}/checkpoint", as_of=AS_OF)
        query.awaitTermination()
    return _processed_rows(spark, f"{root}/processed")


def removed_batches(spark, sf_dir):
    """What is left of the processed batches once a fifth of them are removed, twice."""
    run = process_incoming(spark, _landed_bucket(spark, sf_dir), as_of=AS_OF)
    number = F.regexp_extract("partner_batch_id", r"(\d+)$", 1).cast("int")
    gone = materialise(processed_batches(spark, run.processed).where(number % 5 == 0), "expired").df
    for _ in range(2):
        remove_batches(spark, run.processed, gone)
    root, _, folder = run.processed.rpartition("/")
    left = list_incoming(spark, root, prefix=f"{folder}/", suffix="")
    batch = F.regexp_extract("source_key", "/batch=([^/]+)/", 1).alias("batch")
    return left.select(batch).where("batch <> ''").distinct()


def profiled_files(spark, sf_dir):
    root = _landed_bucket(spark, sf_dir)
    return profile_files(spark, root).select("source_key", "utf8_ok", "usual_header", "n_lines")


def csv_roundtrip(spark, sf_dir):
    path = f"{scratch_root(spark)}/sample-{uuid.uuid4().hex}"
    write_csv(_rows(spark, sf_dir), path)
    return read_all_strings(spark, path)


def queries() -> dict[str, Query]:
    return {
        "structural_violations": structural_violations,
        "rule_invalid_enum": partial(row_rule, "invalid_enum_value"),
        "rule_date_logic": partial(row_rule, "date_logic_violation"),
        "rule_amount_sign": partial(row_rule, "amount_sign_mismatch"),
        "rule_status_amount": partial(row_rule, "status_amount_inconsistency"),
        "rule_zero_value": partial(row_rule, "zero_value_transaction"),
        "rule_duplicate": rule_duplicate,
        "rule_orphaned_refund": rule_orphaned_refund,
        "exceptions_long": lambda s, d: _validated(s, d).exceptions_long(),
        "exceptions_full": lambda s, d: _validated(s, d).exceptions_full(),
        "shared_violations": lambda s, d: _validated(s, d).shared_violations(),
        "row_dispositions": row_dispositions,
        "valid_transactions": lambda s, d: _validated(s, d).valid_rows(),
        "batch_summary": lambda s, d: _validated(s, d).summary(),
        "batch_summary_by_rule": batch_summary_by_rule,
        "raw_id_set": lambda s, d: raw_ids(_rows(s, d), ["source_key"]),
        "id_counts": lambda s, d: id_counts(R.check_rows(_rows(s, d), AS_OF), ["source_key"]),
        "bench_parse": bench_parse,
        "bench_dup_counts": bench_dup_counts,
        "bench_orphans": bench_orphans,
        "bench_flags": lambda s, d: _flagged(s, d).select("row_seq", "critical", "warning"),
        "bench_aggregate": lambda s, d: W.bench_aggregate(W.bench_by_type(_flagged(s, d))),
        "bench_by_type": lambda s, d: W.bench_by_type(_flagged(s, d)),
        "file_gate": file_gate,
        "file_staleness": file_staleness,
        "file_reprocessing": file_reprocessing,
        "file_dispositions": file_dispositions,
        "file_alerts": lambda s, d: G.alerts(_files(s, d)).drop("bucket"),
        "file_dead_letters": lambda s, d: G.dead_letters(_gated(s, d)).drop("bucket"),
        "event_explode": event_explode,
        "retention_expired": retention_expired,
        "refund_link": refund_link,
        "gen_clean": lambda s, d: _plain(_clean(s, d)),
        "gen_benchmark": lambda s, d: _plain(_linked(s, d)),
        "inject_defects": lambda s, d: _plain(_defective(s, d)[0], "is_copy"),
        "gen_seeded": lambda s, d: _plain(_seeded(s, d)[0], "is_copy"),
        "defect_manifest": defect_manifest,
        "manifest_reconcile": reconcile,
        "processed_transactions": processed_transactions,
        "processed_summaries": processed_summaries,
        "versioned_transactions": versioned_transactions,
        "versioned_summaries": versioned_summaries,
        "reprocessing_by_index": reprocessing_by_index,
        "retired_batches": retired_batches,
        "workload_counts": workload_counts,
        "csv_roundtrip": csv_roundtrip,
        "file_profile": profiled_files,
        "utf8_gate": utf8_rejects,
        "quoted_records": quoted_records,
        "pipeline_dispositions": pipeline_dispositions,
        "pipeline_files": pipeline_files,
        "pipeline_transactions": pipeline_transactions,
        "streamed_transactions": streamed_transactions,
        "removed_batches": removed_batches,
    }
