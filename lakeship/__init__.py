"""Ship versioned Parquet tables between places, with Spark doing the work."""

from pyspark import cloudpickle

from lakeship import workers

# Task code travels with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(workers)

from lakeship.operators.compare import compare_tables, diff_rows  # noqa: E402
from lakeship.operators.dml import delete, merge, update  # noqa: E402
from lakeship.operators.fingerprints import verify_content, version_checksum  # noqa: E402
from lakeship.operators.skipping import read_where  # noqa: E402
from lakeship.operators.write import create_table, write_checkpoint, write_table  # noqa: E402
from lakeship.plans.apply import import_bundle, ship, verify_import  # noqa: E402
from lakeship.plans.chain import import_chain, plan_bundles  # noqa: E402
from lakeship.plans.export import export  # noqa: E402
from lakeship.plans.publish import forget_replaced  # noqa: E402
from lakeship.sources.table import read_table, snapshot  # noqa: E402
from lakeship.storage import ShippingError  # noqa: E402
from lakeship.streaming.ship import ship_stream  # noqa: E402

__all__ = [
    "ShippingError",
    "compare_tables",
    "create_table",
    "delete",
    "diff_rows",
    "export",
    "forget_replaced",
    "import_bundle",
    "import_chain",
    "merge",
    "plan_bundles",
    "read_table",
    "read_where",
    "ship",
    "ship_stream",
    "snapshot",
    "update",
    "verify_content",
    "verify_import",
    "version_checksum",
    "write_checkpoint",
    "write_table",
]
