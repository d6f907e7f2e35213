"""Feature store: one wide row per subscriber from the feature tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moontally.operators.joins import anti_join_droplist, id_spine, store_coalesce, store_left_joins
from moontally.operators.rows import quoted
from moontally.plans.contracts import TYPES
from moontally.plans.groups import GROUPS, arpu
from moontally.plans.spec import FeatureGroup, FeatureJob

ID = "bib_id"
#: Tables written at a time.
WRITERS = 4
_ANY_MONTH = FeatureJob(targets=(0,))  # store names do not depend on the month


def store_columns(group: FeatureGroup) -> dict[str, str]:
    """Store name -> name in the group's feature table, in store order."""
    if group.name == arpu.GROUP.name:
        return dict(arpu.STORE_COLUMNS)
    own = [name for name, _ in group.extra_columns] + [name for _, _, name in group.columns(_ANY_MONTH)]
    return {name: name for name in own}


def store_contract() -> T.StructType:
    """Key and all feature columns, in store order."""
    fields = [T.StructField(ID, T.StringType())]
    for group in GROUPS.values():
        types = dict(group.extra_columns) | {name: f.type for _, f, name in group.columns(_ANY_MONTH)}
        fields += [T.StructField(name, TYPES[types[own]]) for name, own in store_columns(group).items()]
    return T.StructType(fields)


def store_part(group: FeatureGroup, table: DataFrame) -> DataFrame:
    """A feature table under its store names."""
    columns = [f"{quoted(own)} AS {quoted(name)}" for name, own in store_columns(group).items()]
    return table.selectExpr(f"{group.key} AS {ID}", *columns)


def store_defaults(tables: Mapping[str, DataFrame]) -> tuple[dict[str, float], dict[str, Column]]:
    """Default per store column: constants, and scalars over the group's own table."""
    constants, queries = {}, {}
    for name, table in tables.items():
        group = GROUPS[name]
        own = {column: f.default_for(w.months) for w, f, column in group.columns(_ANY_MONTH)}
        for store_name, column in store_columns(group).items():
            default = own.get(column)
            if callable(default):
                queries[store_name] = table.agg(default(F.col(quoted(column)))).scalar()
            elif default is not None:
                constants[store_name] = default
    return constants, queries


def wide_by_grouping(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All tables side by side in one shuffle.

    Each row travels as one struct with the other tables' structs NULL; a key has at
    most one row per table, so no group is larger than the number of tables, and the id
    spine is the grouping itself.
    """
    return side_by_side({name: store_part(GROUPS[name], table) for name, table in tables.items()})


def side_by_side(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Parts that share the id column, stacked and grouped once."""
    types = {name: T.StructType([f for f in part.schema.fields if f.name != ID]) for name, part in parts.items()}
    full, absent = {}, {}
    for name, type_ in types.items():
        fields = ", ".join(f"{quoted(f.name)}: {f.dataType.simpleString()}" for f in type_.fields)
        full[name] = f"struct({', '.join(quoted(f.name) for f in type_.fields)}) AS {name}"
        absent[name] = f"CAST(NULL AS STRUCT<{fields}>) AS {name}"
    stacked = [
        part.selectExpr(ID, *[full[name] if other == name else absent[other] for other in parts])
        for name, part in parts.items()
    ]
    one_row = (
        reduce(lambda a, b: a.union(b), stacked)
        .where(F.col(ID).isNotNull())
        .repartition(ID)  # ids rarely meet before the shuffle: no map-side sort and merge
        .groupBy(ID)
        .agg(*[F.any_value(name, ignoreNulls=True).alias(name) for name in parts])
    )
    return one_row.selectExpr(
        ID, *[f"{name}.{quoted(f.name)} AS {quoted(f.name)}" for name, type_ in types.items() for f in type_.fields]
    )


def raw_part(group: FeatureGroup, frame: DataFrame) -> DataFrame:
    """Raw features of a group, typed and under their store names."""
    types = dict(group.extra_columns) | {name: f.type for _, f, name in group.columns(_ANY_MONTH)}
    missing = {name for name, _ in group.extra_columns}
    columns = [
        f"CAST({'NULL' if own in missing else quoted(own)} AS {types[own]}) AS {quoted(name)}"
        for name, own in store_columns(group).items()
    ]
    return frame.selectExpr(f"{group.key} AS {ID}", *columns)


#: Parts of the store by group, under store names, and the keys to drop from all of them; one side per kind of key.
Side = tuple[Mapping[str, DataFrame], DataFrame]


def raw_sides(sides: Sequence[Side]) -> list[Side]:
    """Sides of raw feature frames as sides of store parts."""
    return [({name: raw_part(GROUPS[name], frame) for name, frame in raw.items()}, dropped) for raw, dropped in sides]


def written_sides(sides: Sequence[Side], folder: str, buckets: int) -> list[Side]:
    """The same sides as tables below ``folder``, bucketed and sorted by id.

    Each group is built once, whatever reads it afterwards: spine, joins and defaults. Tables with the same buckets
    join without a shuffle. Tables are written side by side, since one alone does not fill a cluster.
    """

    def write(item: tuple[str, DataFrame]) -> tuple[str, DataFrame]:
        name, frame = item
        table, spark = f"store_{uuid.uuid4().hex}", frame.sparkSession
        dealt = frame.where(F.col(ID).isNotNull()).repartition(buckets, ID)
        dealt.write.bucketBy(buckets, ID).sortBy(ID).option("path", f"{folder}/{name}").saveAsTable(table)
        return name, spark.table(table)

    items = [(name, part) for parts, _ in sides for name, part in parts.items()]
    items += [(f"dropped_{i}", dropped.select(F.col("key").alias(ID)).distinct()) for i, (_, dropped) in enumerate(sides)]
    with ThreadPool(WRITERS) as pool:
        tables = dict(pool.map(write, items, chunksize=1))
    return [
        ({name: tables[name] for name in parts}, tables[f"dropped_{i}"].withColumnRenamed(ID, "key"))
        for i, (parts, _) in enumerate(sides)
    ]


def side_defaults(sides: Sequence[Side]) -> tuple[dict[str, float], dict[str, Column]]:
    """Default per store column; those computed from a frame come from one aggregate over the group's part."""
    constants, queries = {}, {}
    for parts, dropped in sides:
        for name, part in parts.items():
            own = {column: f.default_for(w.months) for w, f, column in GROUPS[name].columns(_ANY_MONTH)}
            computed = {}
            for store_name, column in store_columns(GROUPS[name]).items():
                default = own.get(column)
                if callable(default):
                    computed[store_name] = default(F.col(quoted(store_name)))
                elif default is not None:
                    constants[store_name] = default
            if computed:
                kept = anti_join_droplist(part, dropped, ID)
                all_of = kept.agg(F.struct(*[column.alias(c) for c, column in computed.items()])).scalar()
                queries |= {c: all_of[c] for c in computed}
    return constants, queries


def wide_sides(sides: Sequence[Side], wide: Callable[[Mapping[str, DataFrame]], DataFrame], filled: bool = False) -> DataFrame:
    """The parts of all groups side by side.

    Each drop list is joined once, to the one-row-per-id frame ``wide`` makes of its groups.
    ``filled`` puts defaults where a group has the key, as its feature table does.
    """
    frames, (constants, queries) = [], side_defaults(sides) if filled else ({}, {})
    for parts, dropped in sides:
        if filled:
            parts = {
                name: store_coalesce(part, constants, {c: q for c, q in queries.items() if c in part.columns})
                for name, part in parts.items()
            }
        frames.append(anti_join_droplist(wide(parts), dropped, ID))
    names = [name for group in GROUPS if any(group in parts for parts, _ in sides) for name in store_columns(GROUPS[group])]
    return reduce(lambda a, b: a.join(b, ID, "full_outer"), frames).select(ID, *[quoted(name) for name in names])


def store_of_sides(sides: Sequence[Side], wide: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None) -> DataFrame:
    """The wide table.

    A NULL of a group and a key that the group does not have get the same default, so
    defaults are put in once, at the end.
    """
    return store_coalesce(wide_sides(sides, wide or side_by_side), *side_defaults(sides))


def wide_by_joins(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The same through the id spine and one left join per table."""
    return joined({name: store_part(GROUPS[name], table) for name, table in tables.items()})


def joined(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Parts that share the id column, by left joins from the spine of their ids."""
    tables = [(part, ID) for part in parts.values()]
    return store_left_joins(id_spine(tables, ID), tables, ID)


def feature_store(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Wide table with defaults, in store order; groups without a table stay out."""
    ordered = {name: tables[name] for name in GROUPS if name in tables}
    return store_coalesce(wide_by_grouping(ordered), *store_defaults(ordered))
