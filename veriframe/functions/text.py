"""Text predicates and small text conversions, all built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: width of the time prefix of a driver log line.
LOG_TIME_WIDTH = 24


def contains(column: str | Column, keyword: str) -> Column:
    """Literal substring test: ``%``, ``_`` and quotes in the keyword are plain text."""
    return F.contains(_col(column), F.lit(keyword))


def contains_any(column: str | Column, messages: list[str], regex: bool = False) -> Column:
    """True when any message occurs; ``regex`` reads the messages as patterns."""
    if not messages:
        return F.lit(False)
    if regex:
        return F.rlike(_col(column), F.lit("|".join(messages)))
    return reduce(lambda a, b: a | b, [contains(column, m) for m in messages])


def log_time(column: str | Column) -> Column:
    return F.substring(_col(column), 1, LOG_TIME_WIDTH)


def log_message(column: str | Column) -> Column:
    """Everything after the time prefix; empty for lines that are shorter."""
    value = _col(column)
    return F.substr(value, F.lit(LOG_TIME_WIDTH + 1), F.greatest(F.length(value), F.lit(1)))


def text_list(column: str | Column) -> Column:
    """A list held as text (``['a', 'b']``) as an array; null when it does not parse."""
    return F.from_json(_col(column), "array<string>")


def list_text(column: str | Column) -> Column:
    """An array of strings as list text, the inverse of :func:`text_list`."""
    return F.concat(F.lit("['"), F.array_join(_col(column), "', '"), F.lit("']"))


# Fixed value: what stands before the workspace id in a host name.
HOST_PREFIX = "adb-"


def run_uri(workspace_url: Column, job_id: Column, task_run_id: Column, host_prefix: str = HOST_PREFIX) -> Column:
    """Address of one task run inside a workspace, whose id is the first part of the host name but for the prefix."""
    # Fixed value: the address layout.
    workspace_id = F.replace(F.split(workspace_url, r"\.")[0], F.lit(host_prefix), F.lit(""))
    return F.concat(
        workspace_url, F.lit("/?o="), workspace_id,
        F.lit("#job/"), job_id.cast("string"),
        F.lit("/run/"), task_run_id.cast("string"),
    )


def params_json(params: dict) -> Column:
    """Chosen parameters as JSON text."""
    if not params:
        return F.lit("{}")
    pairs = [F.lit(str(x)) for item in sorted(params.items()) for x in item]
    return F.to_json(F.create_map(*pairs))


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
