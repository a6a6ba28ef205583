"""Queries in text: read-only, over known tables, with the short names that people use."""

from __future__ import annotations

import re
import threading
import time
import uuid
from collections.abc import Callable, Iterator

from py4j.java_gateway import JavaObject, is_instance_of
from py4j.java_collections import JavaArray
from pyspark.core.context import SparkContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Short names of tables, and Russian names of columns.
ALIASES = {
    "cars": "v_car_inventory_summary",
    "car_inventory": "v_car_inventory_summary",
    "elasticsearch_events": "elasticsearch_events_raw",
    "elasticsearch_logs": "elasticsearch_events_raw",
    "elasticsearch_documents": "elasticsearch_events_raw",
}
COLUMN_ALIASES = {
    "город": "city",
    "города": "city",
    "машин": "car_count",
    "машины": "car_count",
    "автомобили": "car_count",
    "автомобилей": "car_count",
    "количество": "car_count",
    "количество_машин": "car_count",
    "количество_автомобилей": "car_count",
}
#: Words that a strict query may not hold.
WRITES = ("insert", "update", "delete", "alter", "drop", "truncate", "create", "grant", "revoke", "optimize")
SUMMARY = "v_car_inventory_summary"
#: Text in quotes of any kind, or a word with what qualifies it, or anything else.
PIECES = re.compile(r"""(?P<quoted>'(?:[^'\\]|\\.|'')*'|"[^"]*"|`[^`]*`)|(?P<word>[\w.]+)|(?P<other>\s+|.)""", re.S)
#: Nodes of a parsed query. Anything else anywhere in the plan is refused: commands, writes, scripts.
QUERY_NODES = frozenset(
    "Project Filter Aggregate Sort Distinct Union Intersect Except GlobalLimit LocalLimit Offset Tail UnresolvedHaving WithWindowDefinition UnresolvedWith "
    "UnresolvedInlineTable LocalRelation ResolvedInlineTable OneRowRelation SubqueryAlias UnresolvedSubqueryColumnAliases UnresolvedHint UnresolvedRelation "
    "UnresolvedTVFAliases UnresolvedTableValuedFunction Pivot Unpivot Join LateralJoin Generate RepartitionByExpression Sample".split()
)
#: Functions that run code by name or look around the machine.
REFUSED = frozenset("reflect java_method try_reflect input_file_name input_file_block_start input_file_block_length".split())
#: Functions that make rows.
TABLE_FUNCTIONS = frozenset("range explode explode_outer posexplode posexplode_outer inline inline_outer stack json_tuple".split())


#: What trees a parsed query is made of, and the other objects that stand in them: values without a tree inside.
TREES = {"plan": "org.apache.spark.sql.catalyst.plans.logical.LogicalPlan", "expression": "org.apache.spark.sql.catalyst.expressions.Expression"}
VALUES = (
    "org.apache.spark.sql.types.DataType", "org.apache.spark.sql.types.Decimal", "org.apache.spark.sql.types.Metadata", "org.apache.spark.unsafe.types.UTF8String",
    "org.apache.spark.unsafe.types.CalendarInterval", "org.apache.spark.sql.util.CaseInsensitiveStringMap", "java.lang.Enum", "scala.Enumeration$Value", "java.util.UUID", "scala.math.BigDecimal",
    "org.apache.spark.sql.catalyst.InternalRow", "org.apache.spark.sql.catalyst.util.ArrayData", "org.apache.spark.sql.catalyst.util.MapData",
)


def _pieces(query: str) -> list[tuple[str, str]]:
    """(kind, text): ``quoted``, ``word`` or ``other``, which is white space or one sign."""
    return [(m.lastgroup or "", m[0]) for m in PIECES.finditer(query)]


def _counted(pieces: list[tuple[str, str]], at: int) -> int | None:
    """The place after ``count(*) AS name`` if it stands at ``at``, without the name; else None."""
    for want in ("count", "(", "*", ")", "as"):
        while at < len(pieces) and not pieces[at][1].strip():
            at += 1
        if at == len(pieces) or pieces[at][0] == "quoted" or pieces[at][1].lower() != want:
            return None
        at += 1
    return at


def rewrite(query: str) -> str:
    """The query with short names replaced; text in quotes and qualified names stay as they are.

    ``count(*) AS x`` where the summary of the inventory is read means its cars and becomes ``sum(cars) AS x``.
    """
    pieces = _pieces(query.strip().rstrip(";").rstrip())
    named, after = [], ""
    for kind, text in pieces:
        low = text.lower()
        if kind == "word":
            text = ALIASES.get(low, text) if after in ("from", "join") else COLUMN_ALIASES.get(low, text)
        named.append((kind, text))
        if text.strip():
            after = low if kind == "word" else ""
    words = [text.lower() for kind, text in named if text.strip()]
    if SUMMARY not in {b for a, b in zip(words, words[1:]) if a in ("from", "join")}:
        return "".join(text for _, text in named)
    out, at = [], 0
    while at < len(named):
        end = _counted(named, at) if named[at][1].lower() == "count" else None
        out.append("sum(cars) AS" if end else named[at][1])
        at = end or at + 1
    return "".join(out)


def _each(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))


def _parts(plan) -> Iterator[tuple[str, str, object]]:
    """(plan or expression, its class, it) of all that a parsed plan is made of, wherever in it that stands.

    Nodes are read field by field, through sequences, options, maps and tuples, so that what a node keeps beside its children, such
    as the windows that a query names, is met as well. An object of an unknown kind raises.
    """
    waiting = [plan]
    while waiting:
        found = waiting.pop()
        if isinstance(found, JavaArray):
            waiting += list(found)
        elif isinstance(found, JavaObject):  # the rest is text, numbers and null
            kind = found.getClass()
            of = _kind(found, kind.getName())
            if of == "sequence":
                waiting += _all(found.iterator())
            elif of != "value":
                if of in TREES:
                    yield of, kind.getSimpleName(), found
                    waiting += _each(found.children())
                waiting += _all(found.productIterator())


_kinds: dict[str, str] = {}


def _kind(found, name: str) -> str:
    """sequence, plan, expression, fields (a tuple or the like) or value, by the object's class."""
    if name not in _kinds:
        a = lambda kind: is_instance_of(SparkContext._gateway, found, kind)
        if a("scala.collection.Iterable"):
            _kinds[name] = "sequence"
        elif a("scala.Product"):
            _kinds[name] = next((kind for kind, of in TREES.items() if a(of)), "fields")
        elif any(map(a, VALUES)):
            _kinds[name] = "value"
        else:
            raise ValueError(f"only queries are allowed, this holds {name}")
    return _kinds[name]


def _all(iterator) -> Iterator:
    while iterator.hasNext():
        yield iterator.next()


def _name(parts) -> str:
    return ".".join(_each(parts)).lower()


def check(spark: SparkSession, query: str, strict: bool = False) -> None:
    """Raises ValueError for anything but one query over known tables.

    Spark's own parser reads the text; every node of the plan must belong to a query, every relation be a table or view of
    the catalog or a WITH part, and no function may run code by name. ``strict`` also demands that the text starts with
    SELECT and holds no word for a change anywhere, not even in a literal.
    """
    if strict and (query[:6].lower() != "select" or {w.lower() for w in re.findall(r"\w+", query)} & {*WRITES}):
        raise ValueError("only SELECT queries without words for changes are allowed")
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(query)
    except Exception as e:
        raise ValueError(f"not one query: {str(e).splitlines()[0]}") from None
    found = list(_parts(plan))
    nodes = [(node, kind) for of, kind, node in found if of == "plan"]
    for _, kind in nodes:
        if kind not in QUERY_NODES:
            raise ValueError(f"only queries are allowed, this holds {kind}")
    parts = {cte._1().lower() for node, kind in nodes if kind == "UnresolvedWith" for cte in _each(node.cteRelations())}
    for node, kind in nodes:
        if kind == "UnresolvedRelation":
            name = list(_each(node.multipartIdentifier()))
            if node.isStreaming():
                raise ValueError("streams are not for queries")
            quoted = ".".join("`" + p.replace("`", "``") + "`" for p in name)
            if not (len(name) == 1 and name[0].lower() in parts) and not spark.catalog.tableExists(quoted):
                raise ValueError(f"unknown table {quoted}")
        if kind == "UnresolvedTableValuedFunction" and _name(node.name()) not in TABLE_FUNCTIONS:
            raise ValueError(f"not a function for queries: {_name(node.name())}")
    for of, kind, node in found:
        if of == "plan":
            continue
        if kind == "ExpressionWithUnresolvedIdentifier":
            raise ValueError("names of functions are written out")
        if kind == "UnresolvedGenerator" and node.name().funcName().lower() not in TABLE_FUNCTIONS:
            raise ValueError(f"not a function for queries: {node.name().funcName()}")
        if kind == "UnresolvedFunction" and (_name(node.nameParts()) in REFUSED or node.nameParts().size() > 1):
            raise ValueError(f"not a function for queries: {_name(node.nameParts())}")


def run_query(spark: SparkSession, query: str, args: dict | None = None, strict: bool = False) -> DataFrame:
    """The result of one read-only query. Values go in as named parameters (:name), not into the text."""
    text = rewrite(query)
    check(spark, text, strict)
    return spark.sql(text, args=args or {})


def rows_within(result: DataFrame, seconds: float = 90.0, attempts: int = 3, pause: Callable[[float], None] = time.sleep) -> list:
    """The rows of a result, for small ones. Its jobs are cancelled after ``seconds``, which raises TimeoutError.

    A run that fails otherwise is tried again, ``attempts`` times in all; a query that cannot be analysed is not.
    """
    context = result.sparkSession.sparkContext
    for attempt in range(1, attempts + 1):
        tag, late = f"query-{uuid.uuid4().hex}", threading.Event()

        def stop(tag=tag, late=late) -> None:
            late.set()
            context.cancelJobsWithTag(tag)

        timer = threading.Timer(seconds, stop)
        context.addJobTag(tag)
        context.setInterruptOnCancel(True)
        timer.start()
        try:
            return result.collect()
        except AnalysisException:
            raise
        except Exception:
            if late.is_set():
                raise TimeoutError(f"the query took more than {seconds} s") from None
            if attempt == attempts:
                raise
            pause(attempt)
        finally:
            timer.cancel()
            context.removeJobTag(tag)
            context.setInterruptOnCancel(False)
    raise ValueError("attempts must be at least 1")
