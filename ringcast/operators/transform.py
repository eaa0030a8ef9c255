"""SQL transform over the exported rows (W10, S7, §2.9 dialect guard).

The rows are registered as the temporary view ``source`` (plus any further
named DataFrames), one query is resolved by ``spark.sql``, and the views are
dropped again right away: the returned DataFrame keeps its resolved plan, so
it still runs after the views are gone. A ``source`` view the caller already
had is put back afterwards.
"""

from __future__ import annotations

import threading
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ringcast.operators.parsed import TransformError, active_session, is_hint, statement_kind, tokens

SOURCE_VIEW = "source"

# View names are per session: resolve one transform at a time; execution is not held.
_RESOLVE_LOCK = threading.RLock()


def strip_comments(sql: str) -> str:
    """``sql`` without comments; quoted text and ``/*+ hints */`` are left alone."""
    out = []
    for t in tokens(sql):
        if t.hidden and t.text.strip() and not is_hint(t):
            out.append(" ")
        else:
            out.append(t.text)
    return "".join(out)


def check_query_text(sql: str) -> str:
    """Refuse text that is not a single query before Spark runs it; returns the
    text without comments and trailing semicolons (safe to nest in a subquery).

    ``spark.sql`` executes DDL and DML eagerly, so a transform such as
    ``DROP TABLE`` would act at once. The session's parser tells what the text
    is: a plan that is a command, or holds one, is refused.
    """
    if not isinstance(sql, str) or not sql.strip():
        raise TransformError("transform SQL is empty")
    text = strip_comments(sql).strip()
    while text.endswith(";"):
        text = text[:-1].rstrip()
    if not text:
        raise TransformError("transform SQL is empty")
    found = statement_kind(active_session(), sql)  # the text as it is: open comments too are the parser's to refuse
    if found is not None:
        raise TransformError(f"transform must be a query, found {found}")
    return text


def _temp_view_exists(spark: SparkSession, name: str) -> bool:
    """A temporary view of that name exists (one lookup, no catalog listing)."""
    try:
        return bool(spark.catalog.getTable(name).isTemporary)
    except Exception:  # no such table or view
        return False


def transform(spark: SparkSession, source: DataFrame | None, sql: str | None,
              tables: Mapping[str, DataFrame] | None = None,
              double_quoted_identifiers: bool = True,
              source_name: str = SOURCE_VIEW, args=None) -> DataFrame:
    """Run ``sql`` over ``source`` (and ``tables``); ``None`` returns ``source``.

    ``double_quoted_identifiers`` makes ``"col"`` a column, as in the
    reference's dialect, instead of a string literal. ``args`` binds
    parameter markers (dict for ``:name``, list for ``?``).
    """
    if sql is None:
        if source is None:
            raise TransformError("no SQL and no source")
        return source
    text = check_query_text(sql)
    views = dict(tables or {})
    if source is not None:
        views[source_name] = source
    with _RESOLVE_LOCK:
        return _resolve(spark, text, views, double_quoted_identifiers, args)


def _resolve(spark, text, views, double_quoted_identifiers, args) -> DataFrame:
    saved = {}
    for name in views:
        if _temp_view_exists(spark, name):
            saved[name] = spark.table(name)
    # Resolved under ANSI (errors on bad casts and overflow, as in the reference's
    # dialect); double-quoted identifiers only take effect under ANSI.
    settings = {"spark.sql.ansi.enabled": "true",
                "spark.sql.ansi.doubleQuotedIdentifiers":
                    "true" if double_quoted_identifiers else "false"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        for k, v in settings.items():
            spark.conf.set(k, v)
        result = spark.sql(text, args=args) if args is not None else spark.sql(text)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
        for name in views:
            spark.catalog.dropTempView(name)
            if name in saved:
                saved[name].createOrReplaceTempView(name)
    return result
