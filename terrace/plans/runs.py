"""Incremental runs of the bank and sales chains over folders of files.

One call brings every dataset up to date: each hop is a streaming query that takes what
its source has gained since the last run and stops. Gold totals are kept as well; the joined
rows, which are an export of all there is, are recomputed from the stored silver tables. Calls repeat safely, since all progress is in the checkpoints.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrace import fixed_values as fixed
from terrace.functions.dates import AsOf
from terrace.operators.append import append_flows
from terrace.operators.cdc import Cdc
from terrace.operators.datasets import save_view
from terrace.operators.quality import Rule
from terrace.plans import bank, sales
from terrace.session import swap_in
from terrace.sources import stream_csv, stream_parquet
from terrace.streaming.change_tables import TYPE_1, TYPE_2, current_rows, history, stream_scd
from terrace.streaming.quality import (
    is_checked,
    quarantined,
    read_checked,
    rule_totals,
    stream_checked,
    write_checked,
)
from terrace.streaming.kept import KeptTable
from terrace.streaming.kept_totals import CUSTOMERS, RESULT, TOTALS, KeptTotals
from terrace.streaming.sinks import finish, write_stream

#: Column of the landing tables with the text of lines that did not parse.
MALFORMED = "malformed_line"


@dataclass(frozen=True)
class Layers:
    """Where the datasets of a chain are stored."""

    spark: SparkSession
    root: str
    _schemas: dict[str, StructType] = field(default_factory=dict)

    def path(self, dataset: str) -> str:
        return f"{self.root}/tables/{dataset}"

    def checkpoint(self, dataset: str) -> str:
        return f"{self.root}/checkpoints/{dataset}"

    def read(self, dataset: str) -> DataFrame:
        if is_checked(self.spark, self.path(dataset)):
            return read_checked(self.spark, self.path(dataset))
        kept = KeptTable(self.spark, self.path(dataset)).last()
        if kept and RESULT in kept.schemas:
            return KeptTable(self.spark, self.path(dataset)).read(kept, RESULT)
        reader = self.spark.read
        if dataset in self._schemas:
            reader = reader.schema(self._schemas[dataset])
        return reader.parquet(self.path(dataset))

    def stream(self, dataset: str) -> DataFrame:
        if is_checked(self.spark, self.path(dataset)):
            return stream_checked(self.spark, self.path(dataset))
        schema = self._schemas[dataset] if dataset in self._schemas else self.read(dataset).schema
        return stream_parquet(self.spark, self.path(dataset), schema)

    def totals(self, dataset: str, money: str | None = None) -> KeptTotals:
        """The kept totals at a dataset's path."""
        kept = KeptTotals(self.spark, self.path(dataset), "customer_id", fixed.GOLD_KEYS, money)
        kept.declare(*(self.read(s).schema for s in ("silver_customers_transformed", "silver_accounts_transactions_transformed")))
        return kept

    def append(self, **datasets: DataFrame) -> None:
        """Bring append-only datasets up to date; the queries run side by side."""
        self._schemas.update({name: df.schema for name, df in datasets.items()})
        finish(
            *[
                write_stream(df, path=self.path(name), checkpoint=self.checkpoint(name))
                for name, df in datasets.items()
            ]
        )

    def capture(self, **datasets: tuple[DataFrame, Cdc, int]) -> None:
        """Bring change tables up to date; the queries run side by side."""
        finish(
            *[
                stream_scd(df, cdc, kind, self.path(name), self.checkpoint(name))
                for name, (df, cdc, kind) in datasets.items()
            ]
        )

    def check(self, malformed: str | None = None, **datasets: tuple[DataFrame, list[Rule]]) -> None:
        """Bring datasets with rules up to date: rows, failing rows and counts in one pass over each source."""
        finish(
            *[
                write_checked(
                    df, rule_list, path=self.path(name), checkpoint=self.checkpoint(name), malformed=malformed
                )
                for name, (df, rule_list) in datasets.items()
            ]
        )

    def quality(self, dataset: str) -> DataFrame:
        """Rule, action, passed and violations of a dataset over all runs."""
        return rule_totals(self.spark, self.path(dataset))

    def quarantine(self, dataset: str) -> DataFrame:
        """Rows that a dataset's drop rules kept out, with the names of those rules."""
        return quarantined(self.spark, self.path(dataset))

    def materialize(self, dataset: str, df: DataFrame) -> DataFrame:
        """Recompute a dataset in full.

        It is written beside the last one, which stays as it is if that fails, and then
        takes its place.
        """
        new = f"{self.root}/replaced/{dataset}-{uuid.uuid4().hex}"
        df.write.parquet(new)
        swap_in(self.spark, new, self.path(dataset))
        self._schemas[dataset] = df.schema
        return self.read(dataset)


def run_bank(
    spark: SparkSession,
    customers_folder: str,
    accounts_folder: str,
    root: str,
    *,
    as_of: AsOf = None,
    max_files: int | None = None,
    customer_tiebreak: tuple[str, ...] = (),
    transaction_tiebreak: tuple[str, ...] = (),
    money: str | None = None,
) -> Layers:
    """Files to gold for the bank datasets; read them from the returned ``Layers``."""
    t = Layers(spark, root)
    t.append(
        landing_customers_incremental=stream_csv(
            spark, customers_folder, fixed.CUSTOMERS_SCHEMA, max_files=max_files, malformed=MALFORMED
        ),
        landing_accounts_incremental=stream_csv(
            spark, accounts_folder, fixed.ACCOUNTS_SCHEMA, max_files=max_files, malformed=MALFORMED
        ),
    )
    landed = bank.clean_customers(t.stream("landing_customers_incremental"))
    t.check(
        MALFORMED,
        # A line that did not parse is no unknown customer: it goes to quarantine.
        bronze_customers_clean=(
            landed.filter(bank.is_known_customer() | F.col(MALFORMED).isNotNull()), bank.customer_rules()
        ),
        bronze_accounts_clean=(bank.clean_accounts(t.stream("landing_accounts_incremental")), bank.account_rules()),
    )
    t.append(
        silver_customers_transformed=bank.silver_customers_transformed(t.stream("bronze_customers_clean"), as_of),
        silver_accounts_transactions_transformed=bank.silver_accounts_transactions_transformed(
            t.stream("bronze_accounts_clean")
        ),
    )
    t.capture(
        silver_customers_transformed_scd1=(
            t.stream("silver_customers_transformed"),
            bank.customers_cdc(*customer_tiebreak),
            TYPE_1,
        ),
        silver_accounts_transactions_transformed_scd2=(
            t.stream("silver_accounts_transactions_transformed"),
            bank.transactions_cdc(*transaction_tiebreak),
            TYPE_2,
        ),
    )
    save_view(
        bank.silver_customers_transformed_view(t.stream("silver_customers_transformed")),
        "silver_customers_transformed_view",
    )
    t.materialize(
        "silver_accounts_transactions_transformed_view",
        bank.silver_accounts_transactions_transformed_view(t.read("silver_accounts_transactions_transformed")),
    )
    t.materialize(
        "gold_cust_acc_trns_mv",
        bank.gold_cust_acc_trns_mv(
            t.read("silver_customers_transformed"), t.read("silver_accounts_transactions_transformed")
        ),
    )
    gold = t.totals("gold_cust_acc_trans_agg", money)
    flows = {CUSTOMERS: "silver_customers_transformed", TOTALS: "silver_accounts_transactions_transformed"}
    finish(
        *[
            gold.stream(part, t.stream(silver), t.checkpoint(f"gold_cust_acc_trans_agg_{part}"))
            for part, silver in flows.items()
        ]
    )
    return t


def run_sales(
    spark: SparkSession,
    customers: DataFrame,
    products: DataFrame,
    feeds: list[DataFrame],
    root: str,
    *,
    mode: str = sales.NAIVE,
    money: str | None = None,
) -> Layers:
    """Source streams to ``business_sales``. ``feeds`` are the regional sales streams."""
    t = Layers(spark, root)
    t.check(
        customers_stg=(customers, sales.customer_rules()),
        products_stg=(products, sales.product_rules()),
        sales_stg=(append_flows(*feeds), sales.sales_rules()),
    )
    customers_view = sales.customers_enr_view(t.stream("customers_stg"))
    products_view = sales.products_enr_view(t.stream("products_stg"))
    sales_view = sales.sales_enr_view(t.stream("sales_stg"))
    t.capture(
        customers_enr=(customers_view, sales.CUSTOMERS, TYPE_1),
        products_enr=(products_view, sales.PRODUCTS, TYPE_1),
        sales_enr=(sales_view, sales.SALES, TYPE_1),
        dim_customers=(customers_view, sales.CUSTOMERS, TYPE_2),
        dim_products=(products_view, sales.PRODUCTS, TYPE_2),
        fact_sales=(sales_view, sales.SALES, TYPE_1),
    )
    t.materialize(
        "business_sales",
        sales.business_sales(
            current_rows(spark, t.path("fact_sales"), sales.SALES),
            history(spark, t.path("dim_customers"), sales.CUSTOMERS),
            history(spark, t.path("dim_products"), sales.PRODUCTS),
            mode,
            money,
        ),
    )
    return t
