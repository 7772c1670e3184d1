import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from batchgate import schema as S  # noqa: E402
from batchgate.session import build_session  # noqa: E402

AS_OF = "2024-02-15"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


BASE = {
    "transaction_id": "TXN-00704118",
    "partner_batch_id": "BATCH-K7",
    "account_id": "ACCT-048213",
    "transaction_date": "2024-02-10",
    "posted_date": "2024-02-12",
    "transaction_type": "purchase",
    "amount": "41.70",
    "currency": "USD",
    "status": "completed",
    "merchant_name": "Harbour Prints",
    "related_transaction_id": "",
    "source_system": "TILL-9",
}


def row(**changes):
    return {**BASE, **changes}


@pytest.fixture
def batch(spark):
    """Rows as dicts -> DataFrame of one file (or of several, by key)."""

    def make(*rows, **files):
        files = files or {"f": rows}
        data = [
            (key, i, *[r[c] for c in S.TRANSACTION_COLUMNS])
            for key, some in files.items()
            for i, r in enumerate(some)
        ]
        ddl = "source_key string, row_seq bigint, " + ", ".join(
            f"{c} string" for c in S.TRANSACTION_COLUMNS
        )
        return spark.createDataFrame(data, ddl)

    return make


@pytest.fixture
def bucket(tmp_path):
    """A bucket folder with a writer for incoming files."""
    root = tmp_path / "bucket"
    (root / "incoming").mkdir(parents=True)

    class Bucket:
        path = str(root)

        def put(self, name, content, mtime=None):
            import os

            target = root / "incoming" / name
            target.write_bytes(content if isinstance(content, bytes) else content.encode())
            if mtime:
                os.utime(target, (mtime, mtime))

        def csv(self, name, *rows, columns=S.TRANSACTION_COLUMNS, mtime=None):
            lines = [",".join(columns)] + [",".join(r.get(c, "x") for c in columns) for r in rows]
            self.put(name, "\n".join(lines) + "\n", mtime)

        def read(self, batch, kind):
            import glob

            found = sorted(glob.glob(f"{root}/processed/batch={batch}/object={kind}/part-*"))
            return "".join(open(f, newline="").read() for f in found) if found else None

    return Bucket()
