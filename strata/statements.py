"""Jobs as SQL text: views over frames, and statements with named parameters.

``views`` names batch or streaming frames; a statement over a streaming view is a
stream. The cart statements say what ``operators.fact`` says with columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CART_ADD = """
SELECT data['id'] AS id, data['user_id'] AS user_id, data['sku_id'] AS sku_id,
       if(type = 'insert', data['sku_num'],
          string(try_cast(data['sku_num'] AS INT) - try_cast(old['sku_num'] AS INT))) AS sku_num,
       data['source_type'] AS source_type, ts
FROM topic_db
WHERE table = :table AND try_cast(data['sku_num'] AS INT) IS NOT NULL
  AND (type = 'insert' OR (type = 'update' AND old['sku_num'] IS NOT NULL
       AND try_cast(data['sku_num'] AS INT) > try_cast(old['sku_num'] AS INT)))
"""

CART_NAMED = """
SELECT cart.id, cart.user_id, cart.sku_id, cart.sku_num, cart.ts, cart.source_type,
       dic.dic_name AS source_type_name
FROM cart_add AS cart JOIN base_dic AS dic ON cart.source_type = dic.dic_code
"""


def views(**frames: DataFrame) -> SparkSession:
    """Make temporary views of ``frames`` (batch or streaming, all of one session) and
    return that session."""
    sessions = []
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
        sessions.append(frame.sparkSession)
    return sessions[0]


def run(text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """The result of one statement over ``frames``; ``args`` are its ``:name`` parameters
    (values, never text put into the statement)."""
    return views(**frames).sql(text, args=args or {})


def cart_add(envelopes: DataFrame, table: str = "cart_info") -> DataFrame:
    return run(CART_ADD, {"table": table}, topic_db=envelopes)


def named_cart(facts: DataFrame, dictionary: DataFrame) -> DataFrame:
    return run(CART_NAMED, cart_add=facts, base_dic=dictionary)
