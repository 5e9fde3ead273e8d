"""The model registry and the two ways of running it.

``Lake.model(name)`` composes models lazily: a KPI over ``fact_sales`` is a
single Catalyst plan from the raw scans to the answer, so pruning and
pushdown reach the Parquet readers.

``build(...)`` materializes the models, one Parquet table per model in a
database named after its layer (bronze / silver / gold, used verbatim).  A
model runs as soon as its own inputs are written and reads them back, so
lineage is cut at every model — an executor lost in the gold layer never
recomputes bronze.  Each run writes folders of its own version and publishes
them together at the end.  A ``layer`` filter runs one layer only, reading
upstream layers from the catalog.  Of the large models that shuffle their rows
one runs at a time, and its shuffle files go when it is written, so that the
disk holds one model's shuffle beside the lake and not those of all models.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from contextlib import nullcontext
from dataclasses import dataclass
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from strata.parallel import DEFAULT_THREADS, run_graph
from strata.plans import models as m
from strata.session import scanned_bytes, tidy_session
from strata.sources import catalog, lake

SOURCE = "source:"
LAYERS = ("bronze", "silver", "gold")

#: Bytes of stored input from which a model that shuffles its rows runs while no other such model does.
ALONE_BYTES = 64 << 20


@dataclass(frozen=True)
class Model:
    name: str  # model name, e.g. "silver_orders"
    alias: str  # table name inside its layer database, e.g. "orders"
    layer: str
    inputs: tuple[str, ...]  # "source:<raw table>" or another model's name
    fn: Callable[..., DataFrame]
    shuffles: bool = False  # its rows go through a shuffle as they are, not as groups or beside a small table


def _bronze(table: str) -> Model:
    return Model(f"bronze_{table}", table, "bronze", (SOURCE + table,), m.bronze)


def _order_fact(name: str, lines: str, fn: Callable[..., DataFrame]) -> Model:
    """Lines joined with their orders."""
    return Model(name, name, "gold", (lines, "silver_orders"), fn, shuffles=True)


# Dependency order: every model appears after its inputs.
# Model, layer and table names are what readers of the lake expect.
MODELS: tuple[Model, ...] = (
    _bronze("category_translation"),
    _bronze("customers"),
    _bronze("geolocation"),
    _bronze("order_items"),
    _bronze("order_payments"),
    _bronze("order_reviews"),
    _bronze("orders"),
    _bronze("products"),
    _bronze("sellers"),
    Model("silver_customers", "customers", "silver", ("bronze_customers",), m.silver_customers),
    Model("silver_geolocation", "geolocation", "silver", ("bronze_geolocation",), m.silver_geolocation),
    Model("silver_order_items", "order_items", "silver", ("bronze_order_items",), m.silver_order_items),
    Model(
        "silver_order_payments",
        "order_payments",
        "silver",
        ("bronze_order_payments",),
        m.silver_order_payments,
    ),
    Model(
        "silver_order_reviews",
        "order_reviews",
        "silver",
        ("bronze_order_reviews",),
        m.silver_order_reviews,
        shuffles=True,
    ),
    Model("silver_orders", "orders", "silver", ("bronze_orders",), m.silver_orders),
    Model(
        "silver_products",
        "products",
        "silver",
        ("bronze_products", "bronze_category_translation"),
        m.silver_products,
    ),
    Model("silver_sellers", "sellers", "silver", ("bronze_sellers",), m.silver_sellers),
    Model("dim_customer", "dim_customer", "gold", ("silver_customers",), m.dim_customer),
    Model("dim_date", "dim_date", "gold", ("silver_orders",), m.dim_date),
    Model("dim_geolocation", "dim_geolocation", "gold", ("silver_geolocation",), m.dim_geolocation),
    Model("dim_product", "dim_product", "gold", ("silver_products",), m.dim_product),
    Model("dim_seller", "dim_seller", "gold", ("silver_sellers",), m.dim_seller),
    Model("fact_orders", "fact_orders", "gold", ("silver_orders",), m.fact_orders),
    _order_fact("fact_payments", "silver_order_payments", m.fact_payments),
    _order_fact("fact_reviews", "silver_order_reviews", m.fact_reviews),
    _order_fact("fact_sales", "silver_order_items", m.fact_sales),
)

BY_NAME: dict[str, Model] = {x.name: x for x in MODELS}

# The star schema (the PySpark job's nine outputs).
STAR_TABLES = (
    "dim_customer",
    "dim_seller",
    "dim_product",
    "dim_date",
    "dim_geolocation",
    "fact_orders",
    "fact_sales",
    "fact_payments",
    "fact_reviews",
)


class Lake:
    """Lazy view of every model over a set of raw source DataFrames."""

    def __init__(
        self,
        sources: Mapping[str, DataFrame],
        pinned: Mapping[str, DataFrame] | None = None,
    ):
        self.sources = sources
        # `pinned` models are already materialized (e.g. read back from Parquet)
        self._memo: dict[str, DataFrame] = dict(pinned or {})
        self._pinned = frozenset(self._memo)

    @classmethod
    def from_catalog(
        cls,
        spark: SparkSession,
        databases: Mapping[str, str] | None = None,
        layers: tuple[str, ...] = ("silver", "gold"),
    ) -> Lake:
        """Models read from materialized tables: KPIs then scan gold, nothing upstream."""
        pinned = {}
        for spec in MODELS:
            name = table_name(spec, databases)
            if spec.layer in layers and spark.catalog.tableExists(name):
                pinned[spec.name] = spark.table(name)
        return cls({}, pinned)

    def source(self, table: str) -> DataFrame:
        return self.sources[table]

    def is_materialized(self, name: str) -> bool:
        """True when ``name`` is read from a written table rather than composed."""
        return name in self._pinned

    def model(self, name: str) -> DataFrame:
        if name not in self._memo:
            spec = BY_NAME[name]
            args = [self._input(i) for i in spec.inputs]
            self._memo[name] = spec.fn(*args)
        return self._memo[name]

    def _input(self, ref: str) -> DataFrame:
        if ref.startswith(SOURCE):
            return self.source(ref[len(SOURCE) :])
        return self.model(ref)


def table_name(model: Model, databases: Mapping[str, str] | None = None) -> str:
    db = (databases or {}).get(model.layer, model.layer)
    return f"{db}.{model.alias}"


def run_databases(run: str) -> dict[str, str]:
    """Layer databases of one run, so that concurrent runs do not overwrite each other's tables."""
    return {layer: f"{layer}__{run}" for layer in LAYERS}


def buildable(sources: Collection[str]) -> list[Model]:
    """The models whose sources are all there, in dependency order."""
    found: dict[str, Model] = {}
    for spec in MODELS:
        if all(ref[len(SOURCE) :] in sources if ref.startswith(SOURCE) else ref in found for ref in spec.inputs):
            found[spec.name] = spec
    return list(found.values())


def build(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    layer: str | None = None,
    databases: Mapping[str, str] | None = None,
    threads: int = DEFAULT_THREADS,
) -> DataFrame:
    """Materialize the models (optionally one layer) and return their inventory.

    Each model is written to a new version folder below
    ``{root}/{layer}/{alias}``, and when all are written the external Parquet
    tables ``{layer}.{alias}`` are pointed at them (a full rebuild per run,
    like a ``table`` materialization; a failed run changes no table).  A model
    starts when its own inputs are written, on one of ``threads`` driver
    threads.  The inventory's row counts and digests are sums of the writes
    themselves.  A model that needs an absent source is left out, and so is
    what depends on it.  Older versions than the one replaced are removed.
    Models that shuffle ``ALONE_BYTES`` of input or more do so one at a time.
    """
    if layer is not None and layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
    # a later layer alone reads the earlier ones from the catalog
    possible = buildable(sources) if layer in (None, "bronze") else list(MODELS)
    specs = {spec.name: spec for spec in possible if layer in (None, spec.layer)}
    if not specs:
        raise ValueError("no model can be built from the sources given")
    version = lake.new_version()
    written: dict[str, lake.Written] = {}
    own, one_shuffle = tidy_session(spark), Lock()

    def write(spec: Model) -> None:
        args = []
        for ref in spec.inputs:
            if ref.startswith(SOURCE):
                args.append(sources[ref[len(SOURCE) :]])
            elif ref in written:
                args.append(written[ref].read(own))
            else:
                args.append(own.table(table_name(BY_NAME[ref], databases)))
        with one_shuffle if spec.shuffles and scanned_bytes(args) >= ALONE_BYTES else nullcontext():
            written[spec.name] = lake.write_digested(
                spec.fn(*args), f"{root}/{spec.layer}/{spec.alias}/{version}"
            )

    run_graph(
        {name: ([i for i in spec.inputs if i in specs], lambda spec=spec: write(spec)) for name, spec in specs.items()},
        threads,
    )
    for current in LAYERS:
        tables = {spec.alias: written[name] for name, spec in specs.items() if spec.layer == current}
        if tables:
            catalog.publish(spark, (databases or {}).get(current, current), tables)
    for spec in specs.values():
        lake.retire(spark, f"{root}/{spec.layer}/{spec.alias}")
    return inventory(spark, [(spec, written[name]) for name, spec in specs.items()])


def inventory(spark: SparkSession, built: list[tuple[Model, lake.Written]]) -> DataFrame:
    """(layer, model, table_name, row_count, digest) of the models just written."""
    return spark.createDataFrame(
        [(spec.layer, spec.name, spec.alias, done.row_count, done.digest) for spec, done in built],
        "layer string, model string, table_name string, row_count long, digest string",
    )
