"""The vendor-brand summary kept up to date from batches of new raw rows.

What the summary needs of the raw tables are sums: purchases by (vendor, name, brand,
description), sales by (vendor, brand), freight by vendor, and price rows with their
multiplicity. A batch is aggregated on its own and stored as partial sums; the summary adds up
the partial sums of all batches. So a refresh reads the new rows only, and any split of
the raw rows into batches gives the summary of them all.

A manifest names the batches that count. It is replaced in one step, after a batch's
sums are complete: a batch that fails midway does not count, and one that is given
twice counts once. ``compact`` adds the stored sums up into one set.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.operators import summary
from marginflow.sources.versions import read_text, replace_text

MANIFEST = "manifest.json"


def partial_sums(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The sums of a batch; a raw table that the batch does not have is left out."""
    build = {"purchases": summary.purchase_sums, "purchase_prices": summary.price_multiplicity,
             "vendor_invoice": summary.freight_summary, "sales": summary.sales_summary}
    return {name: build[name](df) for name, df in raw.items()}


#: The keys of each set of sums; what is not a key is summed.
KEYS = {"purchases": ["VendorNumber", "VendorName", "Brand", "Description"],
        "purchase_prices": ["Brand", "Volume", "Price", "PurchasePrice"],
        "vendor_invoice": ["VendorNumber"], "sales": ["VendorNo", "Brand"]}


def merged(name: str, sums: DataFrame) -> DataFrame:
    """Partial sums of several batches, added up (a sum of nothing but NULLs stays NULL).

    Rows are dealt by Brand alone, so that ``summary.combine`` finds purchases, prices and sales
    where it needs them. They are sums already: a pair has one row for each set of sums at most."""
    if "Brand" in KEYS[name]:
        sums = sums.repartition("Brand")
    return sums.groupBy(*KEYS[name]).agg(*[F.sum(c).alias(c) for c in sums.columns if c not in KEYS[name]])


class SummaryState:
    """The stored partial sums under ``path``, a folder that driver and executors share.

    One writer at a time; readers see the last manifest that was completed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _manifest(self) -> dict:
        text = read_text(self.spark, f"{self.path}/{MANIFEST}")
        return json.loads(text) if text else {"batches": [], "folders": []}

    def batches(self) -> list[str]:
        return self._manifest()["batches"]

    def apply(self, batch: str, raw: dict[str, DataFrame]) -> bool:
        """Adds a batch of raw rows; False if a batch of that name counts already."""
        state = self._manifest()
        if batch in state["batches"]:
            return False
        folder = self._write(partial_sums(raw))
        self._swap({"batches": [*state["batches"], batch], "folders": [*state["folders"], folder]})
        return True

    def compact(self) -> None:
        """Adds up the stored sums into one folder, which replaces the others in the manifest."""
        state = self._manifest()
        if len(state["folders"]) > 1:
            folder = self._write({name: self.sums(name) for name in self._tables(state)})
            self._swap({"batches": state["batches"], "folders": [folder]})

    def _write(self, sums: dict[str, DataFrame]) -> dict:
        base = f"sums-{uuid.uuid4().hex[:12]}"
        for name, df in sums.items():
            df.write.parquet(f"{self.path}/{base}/{name}")
        return {"folder": base, "tables": sorted(sums)}

    def _swap(self, state: dict) -> None:
        replace_text(self.spark, f"{self.path}/{MANIFEST}", json.dumps(state))

    @staticmethod
    def _tables(state: dict) -> list[str]:
        return sorted({t for f in state["folders"] for t in f["tables"]})

    def sums(self, name: str) -> DataFrame:
        """The sums of one raw table over all batches."""
        folders = [f for f in self._manifest()["folders"] if name in f["tables"]]
        if not folders:
            raise LookupError(f"no batch has rows of {name}")
        paths = [f"{self.path}/{f['folder']}/{name}" for f in folders]
        df = self.spark.read.parquet(*paths)
        return df if len(folders) == 1 else merged(name, df)

    def summary(self) -> DataFrame:
        """The summary of all batches' rows."""
        return summary.combine(self.sums("purchases"), self.sums("purchase_prices"),
                               self.sums("vendor_invoice"), self.sums("sales"))
