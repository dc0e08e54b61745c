import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from daybook import LoadSpec  # noqa: E402

INVOICE_COLUMNS = [
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("scratch")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .config("spark.checkpoint.dir", str(scratch / "checkpoint"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def invoice(number, when, description="LAMP", customer="13090.0"):
    return [str(number), "21421", description, "12", when, "1.25", customer, "United Kingdom"]


class Shop:
    """An inbound and a staging folder and a table of its own."""

    def __init__(self, spark, root: Path, name: str):
        self.spark, self.root, self.table = spark, root, f"default.{name}"
        for folder in ("inbound", "staging"):
            (root / folder).mkdir()

    def file(self, name, rows, folder="inbound", columns=INVOICE_COLUMNS):
        def quoted(value):
            return '"' + value.replace('"', '\\"') + '"' if "," in value or '"' in value else value

        lines = [",".join(columns)] + [",".join(quoted(v) for v in row) for row in rows]
        (self.root / folder / name).write_text("\n".join(lines) + "\n")

    def day(self, day, n, folder="inbound", first=0, suffix=".csv"):
        """A file of ``n`` different invoices of one day."""
        rows = [invoice(first + i, f"{day} 08:00:{i % 60:02d}") for i in range(n)]
        self.file(f"{day}{suffix}", rows, folder)

    def settings(self, **settings):
        return {
            "table": self.table,
            "location": str(self.root / "table"),
            "inbound": str(self.root / "inbound"),
            "staging": str(self.root / "staging"),
            **settings,
        }

    def spec(self, **settings):
        return LoadSpec(**self.settings(**settings))

    def classic(self, **settings):
        return LoadSpec.classic(**self.settings(**settings))

    def rows(self):
        return self.spark.table(self.table)

    def counts(self):
        return {r["datestr"]: r["count"] for r in self.rows().groupBy("datestr").count().collect()}


@pytest.fixture
def shop(spark, tmp_path, request):
    name = "".join(c if c.isalnum() else "_" for c in request.node.name).lower()
    made = Shop(spark, tmp_path, f"t_{name}")
    yield made
    spark.sql(f"DROP TABLE IF EXISTS {made.table}")
