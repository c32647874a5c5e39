"""What a SQL statement would do, told by Spark's parser and planner without running it."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession

# Beginnings of the parser's names for statements that change data, tables or settings.
WRITES = ("Insert", "Delete", "Update", "Merge", "Drop", "Truncate", "Create", "Replace", "Alter", "Overwrite", "Append", "Load", "Set", "Reset", "Cache", "Uncache", "Refresh", "Add", "Rename", "Repair", "Recover", "Analyze")
_SCHEMA = "node string, relation string, pushed_filters string, estimated_bytes decimal(38,0), warning string"


def _nodes(plan) -> Iterator:
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def _names(plan) -> str:
    """Tables that an unresolved plan names."""
    out = []
    for node in _nodes(plan):
        if node.nodeName() in ("UnresolvedRelation", "UnresolvedTable", "UnresolvedIdentifier", "UnresolvedTableOrView"):
            parts = node.nameParts() if node.nodeName() == "UnresolvedIdentifier" else node.multipartIdentifier()
            out.append(".".join(parts.apply(i) for i in range(parts.size())))
    return ", ".join(dict.fromkeys(out))


def _estimate(node) -> Decimal | None:
    link = node.logicalLink()
    return Decimal(int(link.get().stats().sizeInBytes())) if link.isDefined() else None


def _scan_row(node) -> tuple:
    """A file scan with what is pushed into it; reading everything is a warning."""
    relation = node.relation()
    named = node.tableIdentifier()
    paths = relation.location().rootPaths()
    where = named.get().unquotedString() if named.isDefined() else ", ".join(paths.apply(i).getName() for i in range(paths.size()))
    pushed = node.metadata().get("PushedFilters")
    pushed = pushed.get() if pushed.isDefined() else "[]"
    parts = node.metadata().get("PartitionFilters")
    unfiltered = pushed == "[]" and (not parts.isDefined() or parts.get() == "[]")
    every_column = node.requiredSchema().size() == relation.dataSchema().size()
    warning = "reads all rows and columns" if unfiltered and every_column else "reads all rows" if unfiltered else None
    return "Scan", where, pushed, _estimate(node), warning


def audit_statement(spark: SparkSession, sql: str) -> DataFrame:
    """Rows ``(node, relation, pushed_filters, estimated_bytes, warning)`` of a statement's plan; nothing is run.

    The first row has the kind of the statement. A statement that changes anything is that row alone, with the tables it names and a
    warning, and so is one that does not parse or whose names are not known. Of a query, every scan, join and exchange of the plan
    has a row; joins of all pairs and scans that read everything are warned of.
    """
    try:
        parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
        kind = parsed.nodeName()
        if kind.startswith(WRITES):
            return spark.createDataFrame([(kind, _names(parsed), None, None, "changes data, tables or settings")], _SCHEMA)
        names = _names(parsed)
        planned = spark._jsparkSession.sessionState().executePlan(parsed, spark._jvm.org.apache.spark.sql.execution.CommandExecutionMode.SKIP())
        planned.assertAnalyzed()
        plan = planned.sparkPlan()
    except (ParseException, AnalysisException, Py4JJavaError) as e:
        return spark.createDataFrame([("Invalid", None, None, None, str(e).splitlines()[0])], _SCHEMA)
    rows = [(kind, names, None, None, None)]
    for node in _nodes(plan):
        name = node.nodeName()
        if name.startswith("Scan ") and hasattr(node, "relation") and node.getClass().getSimpleName() == "FileSourceScanExec":
            rows.append(_scan_row(node))
        elif "Join" in name or "CartesianProduct" in name:
            pairs = "CartesianProduct" in name or "NestedLoop" in name
            rows.append((name, None, None, _estimate(node), "compares all pairs of rows" if pairs else None))
        elif "Exchange" in name or "Scan" in name:
            rows.append((name, None, None, _estimate(node), None))
    return spark.createDataFrame(rows, _SCHEMA)
