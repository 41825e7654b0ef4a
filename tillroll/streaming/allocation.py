"""V3 + U4 on micro-batches: purchase requests are checked and take stock as they arrive.

State (``transformWithState``, a RocksDB state store): the units left of each product, loaded once from the products.
Products are kept by shelf, 256 neighbouring ids in one state value: a call into the state store and a pandas frame cost
as much for one product as for a shelf. The requests of a shelf in a micro-batch are folded in arrival order and every
one is answered at once, so the state of a product is one number whatever the number of requests. After a restart from the same checkpoint the answers go on
where they stopped: batches in order of arrival give what the batch job (``operators.stock.allocate``) gives for all of
them. A product that was unknown when the query first started is answered ``not found`` (V3), as is a request of
less than one unit, and a product without a stock figure refuses, with the batch job's reasons.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tillroll.operators.rules import NOT_FOUND
from tillroll.operators.stock import BELOW_ONE, NO_STOCK, NOT_ENOUGH

REQUESTS = "purchase_id bigint, product_id bigint, quantity bigint, purchased_at timestamp_ntz"
ANSWERS = "purchase_id bigint, product_id bigint, quantity bigint, accepted boolean, remaining bigint, reason string"
#: Products in one state value: the ids that agree but for so many low bits.
SHELF_BITS = 8
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class StockProcessor(StatefulProcessor):
    """Units left of a shelf's products; not there: unknown product; NULL: no stock figure."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.shelf = handle.getValueState("shelf", "products array<bigint>, units array<bigint>")

    def _left(self) -> dict[int, int | None]:
        return dict(zip(*self.shelf.get())) if self.shelf.exists() else {}

    def _keep(self, left: dict[int, int | None]) -> None:
        self.shelf.update((list(left), list(left.values())))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        first = initialState[initialState["product_id"].notna()].drop_duplicates("product_id")
        stock = {int(p): None if pd.isna(s) else int(s) for p, s in zip(first["product_id"], first["stock"])}
        if stock:
            self._keep(self._left() | stock)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        asked = pd.concat(list(rows)).sort_values(["purchased_at", "purchase_id"], kind="stable")
        left = self._left()
        out = []
        for pid, product, qty in zip(asked["purchase_id"], asked["product_id"], asked["quantity"]):
            product, qty = None if pd.isna(product) else int(product), None if pd.isna(qty) else int(qty)
            known, units = product in left, left.get(product)
            reason = NOT_FOUND if not known else NO_STOCK if units is None else BELOW_ONE if (qty or 0) < 1 else NOT_ENOUGH if qty > units else None
            if reason is None:
                units = left[product] = units - qty
            out.append((int(pid), product, qty, reason is None, units, reason))
        if left:
            self._keep(left)
        made = pd.DataFrame(out, columns=["purchase_id", "product_id", "quantity", "accepted", "remaining", "reason"])
        yield made.astype({"product_id": "Int64", "quantity": "Int64", "remaining": "Int64"})

    def close(self) -> None:
        pass


def answers(requests: DataFrame, products: DataFrame) -> DataFrame:
    """The stream of answers to a stream of requests (``REQUESTS``). ``products``: a stored table (a staged snapshot)."""
    shelf = F.shiftright(F.col("product_id").cast("bigint"), SHELF_BITS).alias("_shelf")
    stock = products.select(shelf, "product_id", F.col("quantity").cast("bigint").alias("stock")).groupBy("_shelf")
    return requests.select(shelf, "*").groupBy("_shelf").transformWithStateInPandas(
        StockProcessor(), outputStructType=ANSWERS, outputMode="Append", timeMode="None", initialState=stock)


def start_answering(requests: DataFrame, products: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                    interval: str = "10 seconds") -> StreamingQuery:
    """Answer requests into Parquet files under ``path``; the same checkpoint goes on with the same stock."""
    spark = requests.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)  # a query keeps the provider that it was started with
    try:
        w = answers(requests, products).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
        return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)).start()
    finally:
        spark.conf.set(name, before)


def request_stream(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """Requests from a folder of NDJSON files, oldest file first; ``whole``: all new files are one micro-batch."""
    reader = spark.readStream.schema(REQUESTS)
    return (reader if whole else reader.option("maxFilesPerTrigger", 1)).json(path)
