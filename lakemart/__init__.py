"""lakemart — batch analytics on multi-period tabular releases, built on Spark SQL.

Every public operator is a lazy ``DataFrame -> DataFrame`` (or ``-> Column``)
function so Catalyst sees one declarative plan: filters reach the Parquet
scan, projections are pruned, aggregations run partial + final.

Sub-packages:

* ``lakemart.sources``   – CSV / Parquet readers and writers, catalog, inventory
* ``lakemart.functions`` – Column builders (lenient casts, recoding, measures)
* ``lakemart.operators`` – DataFrame operators (conform, positional join, reports,
                           ordering, data-quality checks)
* ``lakemart.plans``     – the exam lakehouse (bronze → staging → marts), the
                           games notebook flows and the lakehouse runner
"""

from lakemart.session import build_session, scratch_path, ensure_checkpoint_dir

__all__ = ["build_session", "scratch_path", "ensure_checkpoint_dir"]
