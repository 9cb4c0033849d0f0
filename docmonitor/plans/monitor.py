"""One monitoring run: take what is new, publish it, remember it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docmonitor import schema
from docmonitor.operators import documents as D
from docmonitor.operators import files as files_op
from docmonitor.operators import publish as P
from docmonitor.operators import state as S
from docmonitor.operators.navigate import dedupe_requests
from docmonitor.params import RunParams
from docmonitor.plans.documents import classify, clean, judge
from docmonitor.session import materialise
from docmonitor.sources import sinks
from docmonitor.sources import state as store


@dataclass(frozen=True)
class Run:
    """What a run found; lazily evaluated tables."""

    rows: DataFrame      # every candidate with its drop reason
    accepted: DataFrame  # documents to publish
    new_state: DataFrame  # state entries the run adds


def new_rows(files: DataFrame, members: DataFrame, seen: DataFrame) -> DataFrame:
    """Candidate documents no earlier run has: plain files and archive members.

    The first link to a final URL wins.  Known files leave first (links to one URL are of one
    kind, so the two steps commute), archives are expanded after that, and known members
    leave before anything is cleaned.
    """
    fresh = dedupe_requests(
        files_op.not_seen_final(files, seen), "source_file_url", "crawl_seq"
    )
    archives, plain = files_op.route_zip(fresh)
    expanded = files_op.expand_zip_docs(archives, files_op.not_seen_members(members, seen))
    return files_op.as_plain_docs(plain).unionByName(expanded)


def new_state(
    accepted: DataFrame, members: DataFrame, seen: DataFrame, params: RunParams, complete: DataFrame | None = None
) -> DataFrame:
    """State entries of accepted documents and of the archives they complete."""
    if complete is None:
        complete = files_op.complete_zips(accepted, members, seen, params.supported_extensions)
    return S.document_entries(accepted, params.run_ts).unionByName(
        S.zip_entries(complete, accepted, params.run_ts)
    )


def plan_run(
    files: DataFrame, members: DataFrame, seen: DataFrame, params: RunParams
) -> Run:
    """The run as plans, nothing written (what a dry run is)."""
    rows = classify(new_rows(files, members, seen), params)
    accepted = D.kept(rows)
    return Run(rows, accepted, new_state(accepted, members, seen, params))


def _counted(rows: DataFrame, reason: str) -> tuple[DataFrame, Observation]:
    """The rows, which count themselves by reason (in the order of ``D.REASONS``) as they pass."""
    counts = Observation()
    found = [F.count_if(F.col(reason) == name).alias(f"r{i}") for i, name in enumerate(D.REASONS)]
    return rows.observe(counts, F.count_if(F.col(reason).isNull()).alias("kept"), *found), counts


def _by_reason(counts: Observation) -> dict[str, int]:
    got = counts.get
    return {name: got[f"r{i}"] for i, name in enumerate(D.REASONS) if got[f"r{i}"]}


def run_monitor(
    files: DataFrame, members: DataFrame, params: RunParams, root: str, batch_id: int,
    source: str = store.BATCH, lost: DataFrame | None = None,
) -> bool:
    """Run once and record it under ``root``; False if there was nothing to do.

    ``batch_id`` counts within ``source``.  Order of writes: publish output, state entries, then the manifest row that
    makes both count.  A run that dies in between is simply repeated; a batch
    that is in the manifest is skipped.  The documents are computed once: state,
    feed and report all read the published table, and the pass that writes it counts them
    and the dropped rows by reason.  ``lost`` (``url, reason``) are rows that never became
    file rows; they are written beside the documents and counted with the others.
    """
    spark = files.sparkSession
    if params.dry_run or store.is_committed(
        spark, root, batch_id, store.check_source(source)
    ):
        return False
    seen, progress = store.read_seen(spark, root), store.read_progress(spark, root)
    batch_dir = f"{root}/published/source={source}/batch={batch_id}"
    candidates = new_rows(files, members, seen)
    if params.upload_limit:  # the cut and the documents both need them
        candidates = materialise(candidates, "candidates")
    judged, counts = _counted(judge(candidates, params), D.DROP)
    found = clean(D.kept(judged), params)
    found.write.mode("overwrite").parquet(f"{batch_dir}/documents")
    accepted_rows, dropped = counts.get["kept"], _by_reason(counts)
    if lost is not None:
        lost, counts = _counted(lost.select(*schema.LOST.fieldNames()), "reason")
        lost.write.mode("overwrite").parquet(f"{batch_dir}/lost")
        for reason, n in _by_reason(counts).items():
            dropped[reason] = dropped.get(reason, 0) + n
    accepted = spark.read.schema(found.schema).parquet(f"{batch_dir}/documents")
    sinks.write_publish(P.to_publish_records(accepted, params), f"{batch_dir}/records")
    deltas = store.write_progress(
        files_op.progress_deltas(accepted, members, progress, seen, params.supported_extensions), root, batch_id, source)
    complete = files_op.finished_zips(progress.unionByName(deltas), deltas)
    store.write_seen(new_state(accepted, members, seen, params, complete), root, batch_id, source)
    sinks.write_items_csv(accepted, f"{root}/feed")
    sinks.write_report(
        P.run_report(accepted, params), P.report_items(accepted), f"{batch_dir}/report"
    )
    store.commit_batch(
        spark, root, batch_id, params.run_id, params.run_ts, accepted_rows, source, dropped
    )
    if params.export_state:
        store.export_seen_json(store.read_seen(spark, root), f"{root}/export", params.run_ts)
    return True


def published_documents(spark: SparkSession, root: str) -> DataFrame:
    """Documents of all finished runs; before any, an empty table of their keys and batches."""
    try:
        rows = spark.read.option("basePath", f"{root}/published").parquet(
            f"{root}/published/source=*/batch=*/documents"
        ).withColumn("source", F.col("source").cast("string"))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "event_data_key string, source string, batch long")
    finished = store.committed_batches(spark, root).select("source", F.col("batch_id").alias("batch"))
    return rows.join(F.broadcast(finished), ["source", "batch"], "left_semi")
