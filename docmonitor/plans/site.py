"""One run from captured pages to publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmonitor import schema
from docmonitor.operators import documents as D
from docmonitor.operators import files as files_op
from docmonitor.params import RunParams
from docmonitor.plans.monitor import run_monitor
from docmonitor.plans.walk import walk_all
from docmonitor.session import materialise
from docmonitor.sources import state as store


def path_key(path: Column) -> Column:
    """A crawl path as bytes that sort as the path does: four bytes a step, so that rows are
    deduplicated, limited and reported in the walk's order without a number for each row."""
    return F.unhex(F.array_join(F.transform(path, lambda step: F.lpad(F.hex(step), 8, "0")), ""))


def site_files(
    pages: DataFrame, headers: DataFrame, seen: DataFrame, start_url: str, params: RunParams
) -> tuple[DataFrame, DataFrame]:
    """File rows of a site that no earlier run linked, and what was lost on the way (``url, reason``).

    Walk, links not in the state, headers, the run's constants; ``crawl_seq`` is the
    path's key.  What was reached and new is either a file row or a lost one.
    """
    walked = walk_all(pages, start_url, params)
    fresh = files_op.not_seen(D.kept(walked.files), seen)
    found = materialise(files_op.headers_or_reason(fresh, headers), "site-files")
    files = D.with_constants(D.kept(found), params).withColumns({
        "crawl_seq": path_key(F.col("crawl_path")), "department_label": F.col("department"),
    })
    lost = walked.pages
    for rows in (walked.files, found):
        lost = lost.unionByName(D.dropped(rows).select(
            F.col("source_file_url").alias("url"), F.col(D.DROP).alias("reason")))
    return files.select(*schema.DOCUMENTS_IN.fieldNames()), lost


def site_run(
    pages: DataFrame, headers: DataFrame, members: DataFrame, params: RunParams, root: str,
    batch_id: int, start_url: str, source: str = store.BATCH,
) -> bool:
    """Walk a captured site and publish what is new on it; False if there was nothing to do.

    Lost rows are kept beside the publication, and their counts in the manifest.
    """
    spark = pages.sparkSession
    if params.dry_run or store.is_committed(spark, root, batch_id, store.check_source(source)):
        return False
    files, lost = site_files(pages, headers, store.read_seen(spark, root), start_url, params)
    return run_monitor(files, members, params, root, batch_id, source, lost)
