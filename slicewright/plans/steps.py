"""Parameterised SQL steps and scripts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Fixed value: parameters that a step may use.
PARAMETERS = ("data_dt", "proc_run_id")

_PLAIN_VALUE = re.compile(r"[\w.:\- ]*")


def bind_markers(statement: str, values: dict[str, str]) -> str:
    """Replace ``${name}`` markers by plain values; a value that could alter the SQL is refused."""
    for name, value in values.items():
        marker = "${" + name + "}"
        if marker in statement:
            if not _PLAIN_VALUE.fullmatch(value):
                raise ValueError(f"parameter {name} is not a plain value")
            statement = statement.replace(marker, value)
    return statement


def run_steps(
    spark: SparkSession,
    steps: Sequence[tuple[str, str]],
    *,
    data_dt: str,
    proc_run_id: str,
    sources: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Run named SQL statements in order and return the last result.

    Each step sees ``sources`` and earlier steps as ``{name}``, and the
    parameters as ``:data_dt`` and ``:proc_run_id`` (or ``${...}`` markers).
    Queries stay lazy, so consecutive steps are optimised as one plan; the
    first statement that fails ends the run.
    """
    values = dict(zip(PARAMETERS, (data_dt, proc_run_id)))
    frames = dict(sources or {})
    result = None
    for name, statement in steps:
        if not statement.strip():
            continue
        bound = bind_markers(statement, values)
        used = {k: v for k, v in frames.items() if "{" + k + "}" in bound}
        result = frames[name] = spark.sql(bound, args=values, **used)
    if result is None:
        raise ValueError("no SQL step to run")
    return result


def run_script(
    spark: SparkSession,
    script: str,
    *,
    data_dt: str,
    proc_run_id: str,
    sources: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Run a whole SQL script and return the result of its last query.

    The text is not split: Spark runs it as one compound statement, so ``;`` may stand in literals,
    and the script may declare variables and handlers, branch and loop.  Declarations come
    first.  Parameters and ``sources`` are written as in ``run_steps``; a script with other braces has
    no ``sources``.  The first error without a handler ends the run; Spark 4.1
    cannot handle an error in the tasks of a ``SET``.

    Spark hands the last result to the driver, so a script writes large results to tables
    and ends with a short report.
    """
    if not script.strip():
        raise ValueError("no SQL script to run")
    values = dict(zip(PARAMETERS, (data_dt, proc_run_id)))
    body = bind_markers(script, values).rstrip()
    end = "" if body.endswith(";") else ";"
    return spark.sql(f"BEGIN\n{body}{end}\nEND", args=values, **(sources or {}))
