"""The best representative of each duplicate group, built of consistent bundles.

Fields that depend on each other form a *bundle* and are taken from one row together, so that no
address part or number is paired with another row's. Each bundle has a trust. A *functional
dependency* ties bundles: all that it ties must have one value of it. There may be any number of
bundles and dependencies. The survivor is the assignment of rows to bundles of greatest total
trust that keeps all dependencies, found by branch and bound:

* per group, bundle and values of its dependencies only the best candidate can be in an optimum, so
  candidates are aggregated to it first (with partial aggregation: a group that holds a third of all
  rows is a few rows per partition before it is shuffled);
* a node of the search has chosen candidates for the first bundles, which fix dependency values;
* its bound is their trust and, of each bundle that is left, the greatest trust among the
  candidates that agree with the fixed values; nodes whose bound doesn't exceed the best survivor
  so far are cut.

Of candidates of equal trust the preferred one (the caller's order, such as trusted, then recent)
wins, then the smallest row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A candidate of a bundle: trust, row and the value of each dependency (None where the bundle isn't tied by it).
Candidate = tuple[float, int | None, tuple]


@dataclass(frozen=True)
class Bundle:
    """Fields taken together, how much a row is trusted for them, and the values by which they are tied.

    A null ``trust`` makes a row no candidate. ``ties`` has a column for each dependency that ties
    the bundle; null values agree with null only.
    """

    trust: Column
    fields: tuple[str, ...] = ()
    ties: dict[str, Column] = field(default_factory=dict)


def branch_and_bound(bundles: list[list[Candidate]], ties: list[tuple[int, ...]], may_be_empty: bool = True) -> tuple[list[Candidate], float, float, int]:
    """The best consistent choice, its trust, the bound of the root and the number of nodes visited.

    ``bundles`` has the candidates of each, ``ties`` the dependencies that tie it. A bundle without
    a candidate that agrees stays empty, at trust 0; with ``may_be_empty`` any may. Ties: greater
    trust of the earlier bundle, then the smaller values.
    """
    order = [sorted(own, key=lambda c: (-c[0], tuple((v is not None, v or "") for v in c[2]), c[1])) for own in bundles]
    n = max((len(c[2]) for own in bundles for c in own), default=0)
    empty: Candidate = (0.0, None, (None,) * n)
    root = sum(own[0][0] for own in order if own and (own[0][0] > 0 or not may_be_empty))
    fixed: dict[int, object] = {}
    chosen: list[Candidate] = []
    best: list = [None, float("-inf")]
    nodes = 0

    def agrees(k: int, c: Candidate) -> bool:
        return all(d not in fixed or fixed[d] == c[2][d] for d in ties[k])

    def rest(k: int) -> float:
        """The greatest trust that the bundles from ``k`` on can have under the fixed values."""
        out = 0.0
        for i in range(k, len(order)):
            top = next((c[0] for c in order[i] if agrees(i, c)), 0.0)
            out += max(top, 0.0) if may_be_empty else top
        return out

    def visit(k: int, trust: float) -> None:
        nonlocal nodes
        nodes += 1
        if k == len(order):
            if trust > best[1]:
                best[:] = [list(chosen), trust]
            return
        fitting = [c for c in order[k] if agrees(k, c)]
        for c in fitting + ([empty] if may_be_empty or not fitting else []):
            new = [d for d in ties[k] if c is not empty and d not in fixed]
            for d in new:
                fixed[d] = c[2][d]
            chosen.append(c)
            if trust + c[0] + rest(k + 1) > best[1]:
                visit(k + 1, trust + c[0])
            chosen.pop()
            for d in new:
                del fixed[d]

    visit(0, 0.0)
    return best[0] if best[0] is not None else [empty] * len(bundles), best[1], root, nodes


_CHOSEN = "group string, n_rows long, rows array<long>, own_values array<string>, trust double, root_bound double, nodes int"


def _searched(per_group: DataFrame, ties: list[tuple[int, ...]], n_ties: int, may_be_empty: bool) -> DataFrame:
    """``per_group`` (``group``, ``n_rows``, ``candidates`` of ``bundle``, ``own_values``, ``trust``, ``row``) with the best choice of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            groups, sizes, lists = (c.to_pylist() for c in batch.columns)
            for group, n, candidates in zip(groups, sizes, lists):
                bundles: list[list[Candidate]] = [[] for _ in ties]
                for c in candidates:
                    bundles[c["bundle"]].append((c["trust"], c["row"], tuple(c["own_values"])))
                won, trust, root, nodes = branch_and_bound(bundles, ties, may_be_empty)
                values = [next((c[2][d] for k, c in enumerate(won) if d in ties[k] and c[1] is not None), None) for d in range(n_ties)]
                out.append((group, n, [c[1] for c in won], values, trust, root, nodes))
            columns = list(zip(*out)) if out else [[]] * 7
            types = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.float64(), pa.float64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[x.split()[0] for x in _CHOSEN.split(", ")])

    return per_group.select("group", "n_rows", "candidates").mapInArrow(run, _CHOSEN)


def unbeaten(df: DataFrame, group: Column, trusts: dict[str, Column], row: str) -> DataFrame:
    """Per group of two or more rows: the best record under the dependency ``row -> all``.

    The strictest dependency ties every bundle by the row, so that whole rows are the only
    consistent assignments; the survivor meets the bound of the root just when its row is beaten by
    no other in any bundle. Such a row is the best one by any order of the bundles, so the best by
    each rotation of them are candidates enough, however large the group. Returns ``group``,
    ``n_rows``, ``row`` and ``at_root``. Rows of equal trust in all bundles: the smallest ``row``.
    Null groups form none; null trusts are below all others.
    """
    names = [f"t{i}" for i in range(len(trusts))]
    lowest = F.lit(-4e15)
    rows = df.select(group.alias("group"), F.col(f"`{row}`").cast("long").alias("row"), *[F.coalesce(t.cast("double"), lowest).alias(n) for n, t in zip(names, trusts.values())])
    best = [F.max(F.struct(*names[i:], *names[:i], (-F.col("row")).alias("minus"))).alias(f"by_{i}") for i in range(len(names))]
    per_group = rows.where("group IS NOT NULL").groupBy("group").agg(F.count("*").alias("n_rows"), *best).where("n_rows > 1")
    found = F.array_distinct(F.array(*[F.struct((-F.col(f"by_{i}.minus")).alias("row"), *[F.col(f"by_{i}.{n}").alias(n) for n in names]) for i in range(len(names))]))
    # A candidate of each bundle for each row, tied by the row.
    def tied(k: int, name: str) -> Column:
        return F.transform("found", lambda x: F.struct(F.lit(k).alias("bundle"), F.array(x["row"].cast("string")).alias("own_values"), x[name].alias("trust"), x["row"].alias("row")))

    made = [tied(k, name) for k, name in enumerate(names)]
    per_group = per_group.select("group", "n_rows", found.alias("found")).select("group", "n_rows", F.flatten(F.array(*made)).alias("candidates"))
    won = _searched(per_group, [(0,)] * len(names), 1, may_be_empty=False)
    return won.select("group", "n_rows", F.get("rows", F.lit(0)).alias(row), (F.col("trust") == F.col("root_bound")).alias("at_root"))


def choose_rows(df: DataFrame, group: Column, bundles: dict[str, Bundle], preferred: list[Column], row: str = "seq") -> DataFrame:
    """Per group: the row that each bundle of the survivor comes from.

    Columns ``group``, ``n_rows``, ``<bundle>_row`` (null where it stays empty), ``<dependency>`` (the
    value that holds, null if no bundle tied by it has a row), ``trust``, ``root_bound`` and
    ``nodes``. ``preferred`` are columns of which greater ones win among candidates of equal trust.
    Groups of one row are returned too; null groups aren't.
    """
    names = list(dict.fromkeys(d for b in bundles.values() for d in b.ties))
    ties = [tuple(names.index(d) for d in b.ties) for b in bundles.values()]
    own = [
        F.struct(
            F.lit(k).alias("bundle"),
            F.array(*[(b.ties[d].cast("string") if d in b.ties else F.lit(None).cast("string")) for d in names]).cast("array<string>").alias("own_values"),
            b.trust.cast("double").alias("trust"),
        )
        for k, b in enumerate(bundles.values())
    ]
    rows = df.select(group.alias("group"), (-F.col(f"`{row}`").cast("long")).alias("minus"), *[p.alias(f"p{i}") for i, p in enumerate(preferred)], F.inline(F.array(*own)))
    # Dependency values are null beside null; as a grouping key null is a value.
    candidate = F.struct("trust", *[f"p{i}" for i in range(len(preferred))], "minus")
    per_value = rows.where("group IS NOT NULL").groupBy("group", "bundle", "own_values").agg(
        F.count_if(F.col("bundle") == 0).alias("n"), F.max(F.when(F.col("trust").isNotNull(), candidate)).alias("best")
    )
    held = F.when(F.col("best").isNotNull(), F.struct("bundle", "own_values", F.col("best.trust").alias("trust"), (-F.col("best.minus")).alias("row")))
    # As many entries as the dependencies have values, not rows.
    per_group = per_value.groupBy("group").agg(F.sum("n").alias("n_rows"), F.collect_list(held).alias("candidates"))
    won = _searched(per_group, ties, len(names), may_be_empty=True)
    return won.select(
        "group", "n_rows", *[F.get("rows", F.lit(k)).alias(f"{b}_row") for k, b in enumerate(bundles)], *[F.get("own_values", F.lit(i)).alias(d) for i, d in enumerate(names)], "trust", "root_bound", "nodes"
    )


def survivors(df: DataFrame, group: Column, chosen: DataFrame, bundles: dict[str, Bundle], row: str = "seq") -> DataFrame:
    """The survivors themselves: for each bundle the ``fields`` of the row chosen for it.

    The table moves once, by group, to its choices; what isn't chosen goes there, and the chosen
    rows of a group are put together where they are.
    """
    fields = [f for b in bundles.values() for f in b.fields]
    source = df.select(group.alias("group"), F.col(f"`{row}`").cast("long").alias("__row"), *[F.col(f"`{f}`") for f in fields]).where("group IS NOT NULL")
    own = [c for c in chosen.columns if c != "group" and not c.endswith("_row")]
    met = source.join(chosen, "group")
    wanted = F.lit(False)
    for b in bundles:
        wanted = wanted | F.coalesce(F.col(f"{b}_row") == F.col("__row"), F.lit(False))
    took = {b: F.first(F.when(F.col(f"{b}_row") == F.col("__row"), F.struct(*x.fields)), ignorenulls=True).alias(b) for b, x in bundles.items()}
    # A group without any candidate keeps one row, of which nothing is taken.
    none = F.coalesce(*[F.col(f"{b}_row") for b in bundles]).isNull()
    out = met.where(wanted | none).groupBy("group").agg(*[F.first(c).alias(c) for c in own], *took.values())
    return out.select("group", *own, *[F.col(f"{b}.{f}").alias(f) for b, x in bundles.items() for f in x.fields])
