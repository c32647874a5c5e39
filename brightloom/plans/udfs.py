"""User-function surface."""

from __future__ import annotations


from brightloom.functions.numeric import rounded
from brightloom.operators import udfs
from brightloom.plans.common import table
from brightloom.registry import query


@query("scalar_function_apply", "SELECT p_partkey, upper(p_name) || '!' AS shout FROM part")
def scalar_function_apply(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return udfs.scalar_function_apply(p, "p_name", lambda s: s.str.upper() + "!", "string", "shout").drop("p_name")


@query(
    "group_function_apply",
    "SELECT o_orderstatus, count(*) AS n, round(max(o_totalprice) - min(o_totalprice), 2) AS spread, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY o_orderstatus",
)
def group_function_apply(spark, sf):
    out = udfs.group_function_apply(
        table(spark, sf, "orders").select("o_orderstatus", "o_totalprice"), ["o_orderstatus"],
        lambda g: {"n": len(g), "lo": g["o_totalprice"].min(), "hi": g["o_totalprice"].max(), "total": g["o_totalprice"].sum()},
        lambda s: {"n": int(s["n"].sum()), "lo": s["lo"].min(), "hi": s["hi"].max(), "total": s["total"].sum()},
        lambda s: {"n": s["n"], "spread": s["hi"] - s["lo"], "mean": s["total"] / s["n"]},
        "n long, lo double, hi double, total double", "n long, spread double, mean double",
    )
    return out.withColumns({"spread": rounded("spread", 2), "mean": rounded("mean")})


@query(
    "table_function_apply",
    "SELECT doc_id, CAST(unnest(range(len(string_split(text, chr(10))))) AS INTEGER) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents",
)
def table_function_apply(spark, sf):
    def lines(doc_id, text):
        for i, line in enumerate(text.split("\n")):
            yield doc_id, i, line

    return udfs.table_function_apply(table(spark, sf, "documents"), lines, ["doc_id", "text"], "doc_id long, line_no int, line string")
