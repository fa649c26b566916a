"""Reading the driver's parquet tables.

Tables are opened lazily and never with ``select('*')`` downstream, so
Catalyst prunes columns and pushes filters into each parquet scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from riskspark.sources.schema import TableSpec

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


#: Keys of the driver's relational tables, parents first: (table, primary key, foreign keys).
DRIVER_KEYS = (
    ("region", ("r_regionkey",), ()),
    ("nation", ("n_nationkey",), (("n_regionkey", "region", "r_regionkey"),)),
    ("customer", ("c_custkey",), (("c_nationkey", "nation", "n_nationkey"),)),
    ("supplier", ("s_suppkey",), (("s_nationkey", "nation", "n_nationkey"),)),
    ("part", ("p_partkey",), ()),
    ("orders", ("o_orderkey",), (("o_custkey", "customer", "c_custkey"),)),
    ("lineitem", ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"),
     (("l_orderkey", "orders", "o_orderkey"), ("l_partkey", "part", "p_partkey"), ("l_suppkey", "supplier", "s_suppkey"))),
    ("events", ("event_id",), ()),
)


class DriverTables:
    """Lazy handles on ``{sf_dir}/{name}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def specs(self) -> list[TableSpec]:
        """The relational tables as the CSV load declares tables, in load order."""
        return [TableSpec(name, tuple((f.name, f.dataType) for f in self.read(name).schema.fields), key,
                          fks=tuple(((c,), parent, (pc,)) for c, parent, pc in fks)) for name, key, fks in DRIVER_KEYS]

    @cached_property
    def region(self) -> DataFrame:
        return self.read("region")

    @cached_property
    def nation(self) -> DataFrame:
        return self.read("nation")

    @cached_property
    def supplier(self) -> DataFrame:
        return self.read("supplier")

    @cached_property
    def part(self) -> DataFrame:
        return self.read("part")

    @cached_property
    def orders(self) -> DataFrame:
        return self.read("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.read("lineitem")

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events")

    def register_views(self, names=("region", "nation", "supplier", "part", "orders", "lineitem", "events")) -> None:
        for n in names:
            self.read(n).createOrReplaceTempView(n)
