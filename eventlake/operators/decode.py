"""JSON decoding: strict (bad rows set aside) and lenient (bad fields become NULL).

Each payload is read once, and once more only if it is not just what is declared. ``observe``
sits between the decode and any filter on its results: it counts the rows, and it keeps
Catalyst from pushing such a filter below the read, where it would read the payload again for
every field the filter looks at. Filters on message columns belong before the decode: there they
reach the scan.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from eventlake.functions import json_values as J
from eventlake.functions.times import EARLIEST_MS, LATEST_MS
from eventlake.schemas import Field

REASON = "reject_reason"
# The message of a refused row, NULL on a good one: no declared field can hide it.
MESSAGE = "__message"
_ROW, _FINE, _DOC, _READ = "__row", "__fine", "__doc", "__read"
_TOPIC, _PAYLOAD = "__topic", "__payload"


def metrics_name(kind: str) -> str:
    """A name of its own for each decode, so that several can be combined in one query."""
    return f"{kind}_{uuid.uuid4().hex[:12]}"


def _is_object(value: str) -> str:
    # Only asked of text that parsed, so the first character tells the type of the root.
    return rf"startswith(ltrim(' \t\r\n', `{value}`), '{{')"


def _add(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr("*", *[f"{text} AS `{name}`" for name, text in columns.items()])


def _probe(df: DataFrame, fields: tuple[Field, ...], value: str, complete: bool) -> DataFrame:
    """Stage by stage, so that each result is computed once: the fields as text, their quick
    values, whether those will do, the document where they will not, and what that holds of the
    fields that are still open."""
    fine = [_READ]
    for f in fields:
        settled = f"__q_{f.name} IS NOT NULL"
        fine.append(settled if complete else f"({settled} OR {f.of(_ROW)} IS NULL)")
    df = _add(df, {_ROW: J.texts(f"`{value}`", fields)})
    df = _add(df, {_READ: f"({_ROW} IS NOT NULL AND {_ROW}.{J.CORRUPT} IS NULL)"})
    df = _add(df, {f"__q_{f.name}": f"CASE WHEN {_READ} THEN {J.quick(f.of(_ROW), f)} END" for f in fields})
    df = _add(df, {_FINE: " AND ".join(fine)})
    df = _add(df, {_DOC: f"CASE WHEN NOT {_FINE} THEN try_parse_json(`{value}`) END"})
    # An unparseable payload has no document, and one that is no object none that matters.
    df = _add(df, {"__open": f"({_DOC} IS NOT NULL AND {_is_object(value)})"})
    still = {f.name: f"__open AND __q_{f.name} IS NULL" for f in fields}
    df = _add(df, {f"__v_{f.name}": f"CASE WHEN {still[f.name]} THEN {J.raw(_DOC, f)} END" for f in fields})
    return _add(
        df,
        {
            f"__k_{f.name}": f"CASE WHEN {still[f.name]} THEN {J.kind(_DOC, f, f'__v_{f.name}')} END"
            for f in fields
        },
    )


def _resolve(fields: tuple[Field, ...], how: Callable[[str, Field, str, str], str]) -> list[str]:
    return [
        f"CASE WHEN {_FINE} OR __q_{f.name} IS NOT NULL THEN __q_{f.name} "
        f"ELSE {how(_DOC, f, f'__v_{f.name}', f'__k_{f.name}')} END AS `{f.name}`"
        for f in fields
    ]


def decode_strict(
    df: DataFrame,
    fields: tuple[Field, ...],
    *,
    value: str = "value",
    epoch_ms: str | None = None,
    metrics: str | Observation | None = None,
) -> DataFrame:
    """Add the declared fields and ``reject_reason``, NULL on a good row.

    Columns of ``df`` stay unless a field has the same name. ``epoch_ms`` names a field that
    must lie in the range the time functions accept. The topic and payload of a refused row are
    kept apart from all declared fields, for ``rejected``.
    """
    names = {f.name for f in fields}
    kept = [f"`{c}`" for c in df.columns if c not in names]
    kinds = [f"__k_{f.name}" for f in fields]
    checks = [
        f"""CASE WHEN `{f.name}` IS NULL THEN
            CASE WHEN __k_{f.name} IS NULL THEN 'missing:{f.name}'
                 ELSE 'out_of_range:{f.name}' END END"""
        for f in fields
    ]
    if epoch_ms is not None:
        checks.append(
            f"CASE WHEN `{epoch_ms}` NOT BETWEEN {EARLIEST_MS} AND {LATEST_MS} "
            f"THEN 'out_of_range:{epoch_ms}' END"
        )
    reason = f"""CASE
        WHEN NOT {_FINE} AND {_DOC} IS NULL THEN 'unparseable'
        WHEN NOT {_FINE} AND NOT {_is_object(_PAYLOAD)} THEN 'not_object'
        ELSE coalesce({", ".join(checks)}) END"""
    topic = "`topic`" if "topic" in df.columns else "CAST(NULL AS STRING)"
    message = [f"{topic} AS {_TOPIC}", f"`{value}` AS {_PAYLOAD}"]
    decoded = _probe(df, fields, value, complete=True).selectExpr(
        *kept, *message, _FINE, _DOC, *kinds, *_resolve(fields, J.strict)
    )
    decoded = _add(decoded, {REASON: reason})
    refused = f"CASE WHEN {REASON} IS NOT NULL THEN struct({_TOPIC} AS topic, {_PAYLOAD} AS value) END"
    decoded = _add(decoded, {MESSAGE: refused}).drop(_TOPIC, _PAYLOAD, _FINE, _DOC, *kinds)
    return decoded.observe(
        metrics or metrics_name("strict_decode"),
        F.count(F.lit(1)).alias("rows"),
        F.count(F.col(REASON)).alias("rejected"),
    )


def accepted(decoded: DataFrame) -> DataFrame:
    """The good rows of a strict decode."""
    return decoded.where(F.col(REASON).isNull()).drop(REASON, MESSAGE)


def rejected(decoded: DataFrame) -> DataFrame:
    """The bad rows of a strict decode: topic, payload (``value``) and why it was refused."""
    return decoded.where(F.col(REASON).isNotNull()).select(f"{MESSAGE}.topic", f"{MESSAGE}.value", REASON)


def decode_lenient(
    df: DataFrame,
    fields: tuple[Field, ...],
    *,
    value: str = "value",
    keep: tuple[str, ...] = (),
    metrics: str | Observation | None = None,
) -> DataFrame:
    """The declared fields, NULL where missing or unreadable.

    Rows whose payload is no JSON object are skipped. Only ``keep`` and the declared fields
    are carried on.
    """
    usable = f"{_FINE} OR ({_DOC} IS NOT NULL AND {_is_object(value)}) AS __usable"
    decoded = _probe(df, fields, value, complete=False).selectExpr(
        *[f"`{c}`" for c in keep], *_resolve(fields, J.lenient), usable
    )
    decoded = decoded.observe(
        metrics or metrics_name("lenient_decode"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("__usable")).alias("skipped"),
    )
    return decoded.where(F.col("__usable")).drop("__usable")
