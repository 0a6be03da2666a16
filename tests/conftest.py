from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

# Hand-made trace files (header-less CSV).  Comments give the intent of
# each row; expected values in the tests are computed by hand from these.
MACHINE_EVENTS = """\
0,1,0,p1,0.5,0.25
0,2,0,p1,0.5,0.25
0,3,0,p1,,0.5
10,1,1,p1,0.5,0.25
0,4,0,p2,1,1
"""

TASK_EVENTS = """\
10,,1,0,100,0,u1,0,0,0.5,0.25,0.01,0
12,,1,0,100,0,u1,0,0,0.5,0.25,0.01,0
15,,1,0,100,1,u1,0,0,0.5,0.25,0.01,0
9,,1,1,101,0,u1,0,0,0.3,0.2,0.01,0
30,,1,1,101,1,u1,0,0,0.3,0.2,0.01,0
20,,1,1,101,2,u1,0,0,0.3,0.2,0.01,0,extra,fields
50,,3000000000,0,,0,u2,1,9,,0.1,,
40,,3000000000,0,102,5,u2,1,9,,0.1,,
60,,3000000000,0,102,2,u2,1,9,,0.1,,
5,,4,0,103,0,"u,3",2,1,0.2,0.1,0,0
7,,4,1,103,2,"u,3",2,1,0.2,0.1,0,0
8,,4,1,104,2,"u,3",2,1,0.2,0.1,0,0
70,,5,0
"""
# Rows of note: a second, later submit of (1, 0) (first one wins); exit
# before submit for (3000000000, 0) (negative delay); a job id above 2^31;
# a missing machine and missing cpu requests; a quoted comma in `user`;
# extra trailing fields; a short row (job 5); submit at 9 vs 10 (numeric,
# not string, minimum).


def _usage_row(job, task, machine, cpu_rate, max_cpu_rate, mem="0.1"):
    # start, end, job, task, machine, cpu_rate, canonical_memory_usage,
    # 6 more usage columns, maximum_cpu_rate, 6 trailing columns.
    return ",".join(["0", "300", job, task, machine, cpu_rate, mem] + ["0"] * 6
                    + [max_cpu_rate] + ["0"] * 6)


TASK_USAGE = "\n".join([
    _usage_row("1", "0", "100", "0.2", "0.5"),
    _usage_row("1", "1", "101", "0.4", "0.994"),
    _usage_row("3000000000", "0", "102", "", "0.996"),
    _usage_row("3000000000", "0", "102", "0.1", "0.2"),
    _usage_row("4", "0", "103", "0.05", "1.0"),
    _usage_row("6", "0", "105", "0.3", "0.5"),
]) + "\n"

TASK_CONSTRAINTS = (
    "0,1,0,0,a,1\n0,1,0,1,b,2\n"
    + "0,1,1,0,a,1\n" * 4
    + "0,3000000000,0,0,a,1\n" * 60
    + "0,4,1,0,a,1\n"
)


@pytest.fixture(scope="session")
def spark():
    from tracelens.session import build_session

    session = build_session("local[4]", shuffle_partitions=8, app_name="tracelens-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def trace_dir(tmp_path_factory):
    root = tmp_path_factory.mktemp("trace")
    files = {
        "machine_events": MACHINE_EVENTS,
        "task_events": TASK_EVENTS,
        "task_usage": TASK_USAGE,
        "task_constraints": TASK_CONSTRAINTS,
    }
    for name, text in files.items():
        d = root / name
        d.mkdir()
        # Two part files per table: a folder of parts is one table.
        lines = text.splitlines(keepends=True)
        half = len(lines) // 2
        (d / "part-00000.csv").write_text("".join(lines[:half]))
        (d / "part-00001.csv").write_text("".join(lines[half:]))
    (root / "empty").mkdir()
    (root / "empty" / "part-00000.csv").write_text("")
    return str(root)


@pytest.fixture(scope="session")
def trace(spark, trace_dir):
    from tracelens.sources.readers import read_trace_table

    return {name: read_trace_table(spark, name, f"{trace_dir}/{name}")
            for name in ["machine_events", "task_events", "task_usage", "task_constraints"]}


def rows(df, *cols):
    """Result rows as sorted tuples of the given columns (all columns by default)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is None, str(type(v)), v if v is not None else 0) for v in t))


def plan_text(df, mode: str = "simple") -> str:
    """The text ``df.explain(mode)`` prints (physical plan, as a user sees it)."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
