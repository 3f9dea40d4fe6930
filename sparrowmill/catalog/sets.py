"""Set operations and duplicates."""

from pyspark.sql import functions as F

from sparrowmill.operators.sets import except_all
from sparrowmill.operators.windows import dedupe
from sparrowmill.registry import query

_NINETY_ONE = "SELECT c_custkey, c_name FROM customer WHERE c_name LIKE '%_91%'"
_ONE_NINETY_ONE = "SELECT c_custkey, c_name FROM customer WHERE c_name LIKE '%191%'"


def _named(t, pattern):
    return t.customer.filter(F.col("c_name").like(pattern)).select("c_custkey", "c_name")


@query("set_union", "O04", f"{_NINETY_ONE} UNION {_NINETY_ONE} UNION {_NINETY_ONE}")
def set_union(t):
    rows = _named(t, "%_91%")
    return rows.union(rows).union(rows).distinct()


@query("set_union_all", "O05 O10", f"{_NINETY_ONE} UNION ALL {_NINETY_ONE} UNION ALL {_NINETY_ONE}")
def set_union_all(t):
    rows = _named(t, "%_91%")
    return rows.unionAll(rows).unionByName(rows.select("c_name", "c_custkey"))


@query("set_except", "O06", f"{_NINETY_ONE} EXCEPT {_ONE_NINETY_ONE}")
def set_except(t):
    return _named(t, "%_91%").subtract(_named(t, "%191%"))


@query("set_except_all", "O07", f"""
    ({_NINETY_ONE} UNION ALL {_NINETY_ONE}) EXCEPT ALL {_ONE_NINETY_ONE}""")
def set_except_all(t):
    rows = _named(t, "%_91%")
    return except_all(rows.unionAll(rows), _named(t, "%191%"))


@query("dedupe_drop", "O08", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def dedupe_drop(t):
    return dedupe(t.orders.unionAll(t.orders), ["o_orderkey"]).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query("distinct_values", "O09", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_values(t):
    return t.part.select("p_brand", "p_type").distinct()
