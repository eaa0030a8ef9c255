"""What the session's own SQL parser and analyzer say about a query text.

Nothing here reads SQL by itself: Spark's lexer gives the tokens, its parser the
kind of statement and the places of table names, its analyzer the types and the
predicates that parameter markers end up in. Plans are walked on the driver; no
data is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession


class TransformError(ValueError):
    pass


@dataclass
class Token:
    text: str
    start: int
    stop: int  # just past the last character
    hidden: bool  # white space or a comment


def active_session() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def tokens(sql: str) -> list[Token]:
    """The tokens of ``sql`` as Spark's lexer cuts them."""
    jvm = active_session()._jvm
    parser = jvm.org.apache.spark.sql.catalyst.parser
    lexer = parser.SqlBaseLexer(parser.UpperCaseCharStream(jvm.org.antlr.v4.runtime.CharStreams.fromString(sql)))
    lexer.removeErrorListeners()  # the parser reports what is wrong
    return [Token(t.getText(), t.getStartIndex(), t.getStopIndex() + 1, t.getChannel() != 0) for t in lexer.getAllTokens()]


def is_hint(token: Token) -> bool:
    return token.text.startswith("/*+")


def seq(items) -> list:
    """A Scala sequence as a list."""
    return [items.apply(i) for i in range(items.length())]


def kind(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


class Plans:
    """Class tests and walks over plans of the session's JVM."""

    def __init__(self, spark: SparkSession):
        catalyst = "org.apache.spark.sql.catalyst."
        find = spark._jvm.java.lang.Class.forName
        self.command = find(catalyst + "plans.logical.Command")
        self.statement = find(catalyst + "plans.logical.ParsedStatement")
        self.plan = find(catalyst + "plans.logical.LogicalPlan")
        self.holds_plan = find(catalyst + "expressions.PlanExpression")

    def nodes(self, plan) -> Iterator:
        """The plan's nodes and those of its common table expressions."""
        yield plan
        for child in [*seq(plan.children()), *seq(plan.innerChildren())]:
            if self.plan.isInstance(child):
                yield from self.nodes(child)

    def expressions(self, expression) -> Iterator:
        yield expression
        for child in seq(expression.children()):
            yield from self.expressions(child)

    def everything(self, plan) -> Iterator:
        """Every expression of the plan, its subqueries' included."""
        for node in self.nodes(plan):
            for top in seq(node.expressions()):
                for e in self.expressions(top):
                    yield e
                    if self.holds_plan.isInstance(e) and self.plan.isInstance(e.plan()):
                        yield from self.everything(e.plan())


def parse(spark: SparkSession, sql: str):
    """The parsed plan; what the parser refuses is a :class:`TransformError`."""
    try:
        return spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except (PySparkException, Py4JJavaError) as e:
        raise TransformError(f"transform SQL does not parse: {str(e).strip().splitlines()[0]}") from e


# Statements that run at once although the parser does not class them as commands.
RUNS_AT_ONCE = ("UnresolvedExecuteImmediate", "Call", "CompoundBody")


def statement_kind(spark: SparkSession, sql: str) -> str | None:
    """The kind of the first node that is no part of a query, None for a query."""
    plans = Plans(spark)
    for node in plans.nodes(parse(spark, sql)):
        if plans.command.isInstance(node) or plans.statement.isInstance(node) or kind(node) in RUNS_AT_ONCE:
            return kind(node)
    return None


def table_places(spark: SparkSession, sql: str, name: str) -> list[tuple[int, int, bool]]:
    """(start, stop, has an alias) of every place where the text names table ``name``."""
    out = []

    def visit(node, aliased: bool) -> None:
        if kind(node) == "UnresolvedRelation":
            parts = seq(node.multipartIdentifier())
            if len(parts) == 1 and parts[0].lower() == name.lower():
                origin = node.origin()
                out.append((origin.startIndex().get(), origin.stopIndex().get() + 1, aliased))
        for child in [*seq(node.children()), *seq(node.innerChildren())]:
            if plans.plan.isInstance(child):
                visit(child, kind(node) == "SubqueryAlias")

    plans = Plans(spark)
    visit(parse(spark, sql), False)
    return out


# --- what an analysed per-set query says about its markers

def _outer_name(expression) -> str | None:
    """The marker behind an expression: an outer column, at most cast."""
    while kind(expression) in ("Cast", "TempResolvedColumn"):
        expression = expression.child()
    return expression.e().name() if kind(expression) == "OuterReference" else None


def _local_column(expression):
    while kind(expression) == "Cast":
        expression = expression.child()
    return expression if kind(expression) == "AttributeReference" else None


def marker_types(df: DataFrame) -> dict[str, set[str]]:
    """Per marker, the types that the analyzer casts its untyped column to, or
    compares it with."""
    plans, out = Plans(df.sparkSession), {}

    def note(marker, data_type) -> None:
        if kind(marker) == "OuterReference" and data_type.catalogString() != "void":
            out.setdefault(marker.e().name(), set()).add(data_type.catalogString())

    for e in plans.everything(df._jdf.queryExecution().analyzed()):
        if kind(e) == "Cast":
            note(e.child(), e.dataType())
        elif kind(e) in _OPERATORS or kind(e) == "EqualNullSafe":
            if _outer_name(e.left()) is None or _outer_name(e.right()) is None:
                note(e.left(), e.right().dataType())
                note(e.right(), e.left().dataType())
    return out


@dataclass
class Compared:
    """A table's column compared with a marker, in a filter right above the table."""
    table: str
    column: str
    operator: str  # =, <, <=, >, >=
    marker: str
    cut: bool  # something above the filter counts, ranks or limits rows


_OPERATORS = {"EqualTo": "=", "LessThan": "<", "LessThanOrEqual": "<=", "GreaterThan": ">", "GreaterThanOrEqual": ">="}
_SWAPPED = {"=": "=", "<": ">", "<=": ">=", ">": "<", ">=": "<="}
_PASSING = ("Project", "SubqueryAlias", "Filter", "View")


def compared_columns(df: DataFrame) -> list[Compared]:
    """The marker predicates of the lateral subquery in ``df``: conjuncts that every
    row of a table named once in the subquery must pass."""
    plans = Plans(df.sparkSession)
    out: list[Compared] = []
    views: dict[str, int] = {}

    def view_name(node) -> str:
        return node.desc().identifier().table()

    def conjuncts(condition) -> list:
        """(operator, left, right) of every comparison that must hold."""
        if kind(condition) == "And":
            return conjuncts(condition.left()) + conjuncts(condition.right())
        if kind(condition) == "Between":
            return conjuncts(seq(condition.children())[0])
        if kind(condition) == "With" and len(seq(condition.defs())) == 1:  # a value named once, compared twice
            value = seq(condition.defs())[0].child()
            named = [[value if kind(x) == "CommonExpressionRef" else x for x in sides] for _, *sides in conjuncts(condition.child())]
            return [(c[0], *sides) for c, sides in zip(conjuncts(condition.child()), named)]
        operator = _OPERATORS.get(kind(condition))
        return [(operator, condition.left(), condition.right())] if operator else []

    def below(node) -> dict[int, tuple[str, str]]:
        """Column ids of the tables below, through nodes that keep rows and columns as they are."""
        if kind(node) == "View":
            return {a.exprId().id(): (view_name(node), a.name()) for a in seq(node.output())}
        if kind(node) in _PASSING or (kind(node) == "Join" and node.joinType().toString() in ("Inner", "Cross")):
            found = {}
            for child in seq(node.children()):
                found |= below(child)
            return found
        return {}

    def visit(node, cut: bool) -> None:
        if kind(node) == "View":
            views[view_name(node)] = views.get(view_name(node), 0) + 1
            return
        if kind(node) == "Filter":
            columns = below(node.child())
            for operator, left, right in conjuncts(node.condition()):
                for mine, other, sign in ((left, right, operator), (right, left, _SWAPPED[operator])):
                    column, marker = _local_column(mine), _outer_name(other)
                    if column is not None and marker is not None and column.exprId().id() in columns:
                        out.append(Compared(*columns[column.exprId().id()], sign, marker, cut))
        inner = kind(node) in _PASSING or (kind(node) == "Join" and node.joinType().toString() in ("Inner", "Cross"))
        for child in [*seq(node.children()), *seq(node.innerChildren())]:
            if plans.plan.isInstance(child):
                visit(child, cut or not inner)
        for top in seq(node.expressions()):
            for e in plans.expressions(top):
                if plans.holds_plan.isInstance(e) and plans.plan.isInstance(e.plan()):
                    visit(e.plan(), True)

    for node in plans.nodes(df._jdf.queryExecution().analyzed()):
        if kind(node) == "LateralJoin":
            visit(node.right().plan(), False)
            break
    return [c for c in out if views.get(c.table) == 1]
