"""DWD facts: cart-add from before/after deltas, and the dictionary lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.sizing import broadcast_if_small

# A dictionary is small by nature; beyond this the lookup shuffles.
MAX_DICTIONARY_ROWS = 1_000_000


def cart_add(envelopes: DataFrame, table: str = "cart_info", carry: tuple[str, ...] = (),
             rejects: bool = False):
    """Cart additions: inserts, and updates whose count grew.

    ``sku_num`` is the inserted count or the increase (new - old). Updates
    without an old count, or with a smaller or equal count, are no additions.
    Rows whose count is not a number are left out; with ``rejects`` the result
    is (facts, rejected envelopes). ``carry`` names further columns to keep.
    """
    new = F.col("data")["sku_num"].try_cast("int")
    old = F.col("old")["sku_num"].try_cast("int")
    is_insert = F.col("type") == "insert"
    change = (F.col("type") == "update") & F.col("old")["sku_num"].isNotNull()
    own = envelopes.where((F.col("table") == table) & (is_insert | change))
    bad = new.isNull() | (change & old.isNull())
    facts = own.where(~bad & (is_insert | (new > old))).select(
        F.col("data")["id"].alias("id"),
        F.col("data")["user_id"].alias("user_id"),
        F.col("data")["sku_id"].alias("sku_id"),
        F.when(is_insert, F.col("data")["sku_num"]).otherwise((new - old).cast("string")).alias("sku_num"),
        F.col("data")["source_type"].alias("source_type"),
        "ts", *carry,
    )
    return (facts, own.where(bad)) if rejects else facts


def lookup(facts: DataFrame, dictionary: DataFrame, fact_key: str = "source_type",
           code: str = "dic_code", name: str = "dic_name", out: str = "source_type_name",
           max_rows: int = MAX_DICTIONARY_ROWS) -> DataFrame:
    """Inner lookup join: facts without a dictionary entry drop. The dictionary
    side is broadcast only when its row count is checked below ``max_rows``."""
    dic = dictionary.select(F.col(code).alias("_code"), F.col(name).alias(out))
    joined = facts.join(broadcast_if_small(dic, max_rows), F.col(fact_key) == F.col("_code"), "inner")
    return joined.drop("_code")
