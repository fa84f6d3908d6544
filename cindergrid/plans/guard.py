"""What ad-hoc SQL may say: an allow-list over the parsed text, checked before Spark analyses or runs anything.

Spark executes some statements while it analyses them, so nothing may reach it that is not known to be a
query. Every node of the parsed plan, its expressions, subqueries and WITH parts must be on the list, relations must
be registered views or WITH names, and functions built-in ones of harmless groups, not overridden by others.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator

from pyspark.sql import DataFrame, SparkSession

_CATALYST = "org.apache.spark.sql.catalyst"

#: Parsed plan nodes that only read and compute.
PLAN_NODES = {
    f"{_CATALYST}.plans.logical.{name}"
    for name in (
        "Project", "Filter", "Aggregate", "Join", "Sort", "GlobalLimit", "LocalLimit", "Offset", "Distinct", "SubqueryAlias",
        "Union", "Intersect", "Except", "OneRowRelation", "LocalRelation", "UnresolvedWith", "WithWindowDefinition", "Generate", "Pivot",
    )
} | {
    f"{_CATALYST}.analysis.{name}"
    for name in ("UnresolvedRelation", "UnresolvedInlineTable", "UnresolvedHaving", "UnresolvedSubqueryColumnAliases")
}
_RELATION, _WITH = f"{_CATALYST}.analysis.UnresolvedRelation", f"{_CATALYST}.plans.logical.UnresolvedWith"
#: Expressions that the parser writes itself are operators, literals, subqueries and the like; of those that
#: are still to be resolved these are columns, stars and calls, and calls are looked at by name.
EXPRESSIONS = f"{_CATALYST}.expressions."
UNRESOLVED = {
    f"{_CATALYST}.analysis.{name}"
    for name in (
        "UnresolvedAttribute", "UnresolvedStar", "UnresolvedAlias", "UnresolvedOrdinal", "UnresolvedExtractValue",
        "UnresolvedFunction", "UnresolvedGenerator", "UnresolvedRegex", "MultiAlias", "UnresolvedOrderByAll", "UnresolvedGroupByAll",
    )
}
_CALL, _GENERATOR = f"{_CATALYST}.analysis.UnresolvedFunction", f"{_CATALYST}.analysis.UnresolvedGenerator"
#: Groups of built-in functions; the group of the rest calls into the JVM, raises errors or tells about the session.
FUNCTION_GROUPS = {
    f"{name}_funcs"
    for name in (
        "agg", "array", "bitwise", "collection", "conditional", "conversion", "csv", "datetime", "generator", "hash", "json",
        "lambda", "map", "math", "predicate", "string", "struct", "url", "variant", "window",
    )
}


#: What is read from files; other leaves are rows of the query or of the session, and their size is often unknown.
_FILES = "org.apache.spark.sql.execution.datasources.LogicalRelation"


def _all_of(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _kind(node) -> str:
    return node.getClass().getName()


def _nodes(plan) -> Iterator:
    """A plan's nodes, with those of subqueries and WITH parts."""
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        yield node
        waiting += _all_of(node.children()) + _all_of(node.subqueries())
        if _kind(node) == _WITH:
            waiting += _all_of(node.innerChildren())


def _expressions(node) -> Iterator:
    waiting = _all_of(node.expressions())
    while waiting:
        expression = waiting.pop()
        yield expression
        waiting += _all_of(expression.children())


def _names_of(node) -> set[str]:
    """The names that a WITH gives."""
    return {part.alias().lower() for part in _all_of(node.innerChildren())} if _kind(node) == _WITH else set()


def _function_allowed(spark: SparkSession, name: str) -> bool:
    """A built-in of an allowed group that no other function of the session stands in for."""
    known = spark._jvm.org.apache.spark.sql.catalyst.FunctionIdentifier(name.lower())
    built_in = spark._jvm.org.apache.spark.sql.catalyst.analysis.FunctionRegistry.builtin().lookupFunction(known)
    here = spark._jsparkSession.sessionState().functionRegistry().lookupFunction(known)
    if built_in.isEmpty() or here.isEmpty() or here.get().getClassName() != built_in.get().getClassName():
        return False
    return built_in.get().getGroup() in FUNCTION_GROUPS


def require_query(spark: SparkSession, text: str, views: Collection[str]) -> None:
    """Raise ``PermissionError`` unless the text is a query over these views by the lists above; nothing is run."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    nodes = list(_nodes(plan))
    for node in nodes:
        if _kind(node) not in PLAN_NODES:
            raise PermissionError(f"ad-hoc SQL must be a query; {node.getClass().getSimpleName()} is not allowed")
    readable = {v.lower() for v in views}.union(*map(_names_of, nodes))
    for node in nodes:
        if _kind(node) == _RELATION:
            name = [part.lower() for part in _all_of(node.multipartIdentifier())]
            if len(name) != 1 or name[0] not in readable or node.isStreaming():
                raise PermissionError(f"{'.'.join(name)} is not open to ad-hoc SQL")
        for expression in _expressions(node):
            kind = _kind(expression)
            if kind not in UNRESOLVED and not kind.startswith(EXPRESSIONS):
                raise PermissionError(f"{expression.getClass().getSimpleName()} is not allowed in ad-hoc SQL")
            if kind in (_CALL, _GENERATOR):
                called = expression.nameParts() if kind == _CALL else None
                parts = _all_of(called) if called is not None else [expression.name().funcName()]
                if len(parts) != 1 or not _function_allowed(spark, parts[0]):
                    raise PermissionError(f"the function {'.'.join(parts)} is not allowed in ad-hoc SQL")


def require_views(rows: DataFrame, views: Collection[str]) -> None:
    """Raise ``PermissionError`` if the analysed query reads anything but these views.

    A WITH name may be that of a table, which its own definition would then read; the text does not tell.
    """
    waiting = [rows._jdf.queryExecution().analyzed()]
    while waiting:
        node = waiting.pop()
        kind = _kind(node).removeprefix(f"{_CATALYST}.plans.logical.")
        if kind == "View":
            if node.desc().identifier().table().lower() not in views:
                raise PermissionError(f"{node.desc().identifier().table()} is not open to ad-hoc SQL")
            continue  # what a registered view reads is its own affair
        if node.children().isEmpty() and not kind.startswith(("OneRow", "LocalRelation", "CTERelationRef")):
            raise PermissionError("ad-hoc SQL reads registered views only")
        waiting += _all_of(node.children()) + _all_of(node.subqueries())


def require_bounded(rows: DataFrame, most_bytes: int | None) -> None:
    """Raise ``PermissionError`` for joins that pair all rows, and for scans beyond ``most_bytes``.

    Both are read off the optimised plan, so filters that prune partitions count, and nothing is run. A side
    of one row at most is no such join.
    """
    keys = rows.sparkSession._jvm.org.apache.spark.sql.catalyst.planning.ExtractEquiJoinKeys
    scanned = 0
    for node in _nodes(rows._jdf.queryExecution().optimizedPlan()):
        if _kind(node) == f"{_CATALYST}.plans.logical.Join":
            single = any(side.maxRows().isDefined() and side.maxRows().get() <= 1 for side in (node.left(), node.right()))
            if not single and keys.unapply(node).isEmpty():
                raise PermissionError("ad-hoc SQL may join on equal keys only")
        if _kind(node) == _FILES:
            scanned += int(node.stats().sizeInBytes())
    if most_bytes is not None and scanned > most_bytes:
        raise PermissionError(f"the query would read about {scanned} bytes, more than {most_bytes}")
