"""Sample by taxon tables that tell "not looked for" from "absent"."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brinedeck.fixed_values import NOT_LOOKED_FOR
from brinedeck.functions.missing import not_in, sum_or_zero, sum_strict
from brinedeck.functions.text import first_word, genus_species
from brinedeck.operators.shuffle import keep_all_samples, salted_lookup


def changed_in_log(log: DataFrame, level: str, taxon: str = "TaxonName", parent: str = "ParentName") -> DataFrame:
    """Change-log rows whose genus (first word) or whole name differs from the parent's."""
    if level == "genus":
        return log.filter(first_word(F.col(taxon)) != first_word(F.col(parent)))
    if level == "name":
        return log.filter(F.col(taxon) != F.col(parent))
    raise ValueError(f"unknown level {level!r}")


def in_change_log(obs: DataFrame, changed: DataFrame, taxon: str = "TaxonName") -> DataFrame:
    return obs.join(changed.select(taxon).distinct(), taxon, "left_semi")


def not_in_change_log(obs: DataFrame, changed: DataFrame, taxon: str = "TaxonName") -> DataFrame:
    """Complement of ``in_change_log``; rows without a name are kept."""
    return obs.join(changed.select(taxon).distinct(), taxon, "left_anti")


def fill_missing_sample(df: DataFrame, name: str, value: str, label: str) -> DataFrame:
    """Placeholder name and 0 for samples in which nothing was found."""
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(label)),
        value: F.coalesce(F.col(value), F.lit(0.0)),
    })


def first_start(affected: DataFrame, key: str, name: str, start: str) -> DataFrame:
    """Start date of the first record of each name in (sample, start) order."""
    return affected.groupBy(name).agg(F.min_by(start, F.struct(key, start)).alias("_default_start"))


def apply_change_log(
    samples: DataFrame,
    obs: DataFrame,
    log: DataFrame,
    *,
    level: str,
    key: str,
    date: str,
    name: str,
    value: str,
    placeholder: str,
    taxon: str = "TaxonName",
    start: str = "StartDate",
    dims: Sequence[str] | None = None,
    plain_where: Column | None = None,
    affected_where: Column | None = None,
    plain_name: Column | None = None,
) -> DataFrame:
    """Totals per sample and name under the presence rule of the change log.

    A taxon in the log was not told apart before its start date, so a sample
    before that date gets -999, a later sample without a record gets 0, and a
    record is kept.  A sample on the very start date without a record is
    unknown.  Where a name has both logged and other taxa the larger value
    wins.  Samples that share ``dims`` are added up within either part before
    the larger part is taken.  ``samples`` has one row per ``key``; ``obs`` needs ``key``,
    ``taxon``, ``name`` and ``value``; ``plain_name`` renames the unlogged part
    after summing.  ``dims`` names the columns that identify a sample in the
    result where that is not its key.
    """
    cells, names = _cells(
        samples, obs, log, level=level, key=key, date=date, name=name, value=value, placeholder=placeholder, taxon=taxon, start=start,
        plain_where=plain_where, affected_where=affected_where, plain_name=plain_name,
    )
    parts = _grid(samples, cells, names, key=key, date=date, name=name)
    if dims is None:
        return parts.select(*samples.columns, name, _larger("_logged", "_known", "_plain").alias(value))
    summed = parts.groupBy(*dims, name).agg(
        F.sum("_plain").alias("_plain"), sum_strict(F.col("_known")).alias("_known"), F.max("_logged").alias("_logged"),
    )
    return summed.select(*dims, name, _larger("_logged", "_known", "_plain").alias(value))


def _cells(
    samples: DataFrame, obs: DataFrame, log: DataFrame, *,
    level: str, key: str, date: str, name: str, value: str, placeholder: str, taxon: str, start: str,
    plain_where: Column | None, affected_where: Column | None, plain_name: Column | None,
) -> tuple[DataFrame, DataFrame]:
    """What was found: the sample's columns, name, plain and found; and the logged names with their default start.

    ``plain`` is the total of the unlogged taxa of a name, ``found`` that of the logged ones by the rule
    for records.  A sample without any plain name has the placeholder as one, with 0.  All but the
    totals stays in the partitioning by sample.
    """
    logged = changed_in_log(log, level, taxon).select(taxon, F.lit(True).alias("_logged")).distinct()
    rows = obs.join(logged.join(log.select(taxon, start), taxon), taxon, "left").withColumn(
        "_logged", F.coalesce("_logged", F.lit(False))
    ).filter(F.col(name) != "")
    if plain_where is not None:
        rows = rows.filter(F.col("_logged") | plain_where)
    if affected_where is not None:
        rows = rows.filter(~F.col("_logged") | affected_where)
    if plain_name is not None:
        rows = rows.withColumn(name, F.when(F.col("_logged"), F.col(name)).otherwise(plain_name))
    totals = rows.groupBy(key, name, "_logged", start).agg(sum_or_zero(F.col(value)).alias(value))

    recorded = F.when(F.col(start) > F.col(date), F.lit(NOT_LOOKED_FOR)).otherwise(F.col(value))
    unlogged = ~F.col("_logged")
    own = F.struct(F.col(name), F.when(unlogged, F.col(value)).alias("plain"), F.when(F.col("_logged"), recorded).alias("found"))
    stand_in = F.struct(F.lit(placeholder).alias(name), F.lit(0.0).alias("plain"), F.lit(None).cast("double").alias("found"))
    any_plain = F.coalesce(F.max(unlogged).over(W.partitionBy(key)), F.lit(False))
    parts = _parts(samples)
    dated = samples.repartition(parts, key).join(totals.repartition(parts, key), key, "left").withColumn("_any_plain", any_plain)
    rows_of = F.when(F.col("_any_plain"), F.array(own)).when(F.col("_logged"), F.array(own, stand_in)).otherwise(F.array(stand_in))
    cells = dated.select(*samples.columns, F.inline(rows_of)).groupBy(*samples.columns, name).agg(F.sum("plain").alias("plain"), F.sum("found").alias("found"))
    names = first_start(totals.filter("_logged"), key, name, start).withColumns({
        "_default_start": F.col("_default_start").cast("timestamp_ntz"), "_logged": F.lit(True),
    })
    return cells, names


#: Samples whose records, or whose row of the grid, a task holds.
SAMPLES_TOGETHER = 1 << 15


def _parts(samples: DataFrame) -> int:
    """Partitions of samples: the session's number, or more where a task would hold too many samples."""
    return max(int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-samples.count() // SAMPLES_TOGETHER))


def _tiled(rows: DataFrame, small: DataFrame, spread: Sequence[str], tiles: int | None = None) -> DataFrame:
    """Every row of ``rows`` with every row of ``small``, where that is the result asked for.

    ``rows`` are dealt to tiles by a hash of ``spread`` and each tile meets its own copy of ``small``, by
    an equi-join: a task holds the pairs of its tile only, and neither table is gathered in one row.
    ``tiles`` is given for rows that grow with the input, so that a task's share does not.
    """
    dealt = tiles is not None
    tiles = tiles or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = small.withColumn("_tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    placed = rows.withColumn("_tile", F.pmod(F.xxhash64(*spread), F.lit(tiles)).cast("int"))
    if dealt:
        placed, copies = placed.repartition(tiles, "_tile"), copies.repartition(tiles, "_tile")
    return placed.join(copies, "_tile").drop("_tile")


def _absent(start: Column, date: Column) -> Column:
    """Value of a logged name without a record: unknown on the very start date."""
    return F.when(start > date, F.lit(NOT_LOOKED_FOR)).when(start < date, F.lit(0.0))


def _grid(samples: DataFrame, cells: DataFrame, names: DataFrame, *, key: str, date: str, name: str) -> DataFrame:
    """Every sample with every logged name, and with the other names found in it, in two parts ``_plain`` and ``_known``.

    The names found in a sample, at most a taxonomy, are packed into one map
    per sample, so only records and samples are shuffled.  The grid of samples
    and logged names, by far the largest table here, is written out row by row
    from the packed samples and never moves.
    """
    entry = F.struct(F.col(name), F.struct("plain", "found"))
    packed = cells.groupBy(*samples.columns).agg(F.map_from_entries(F.collect_list(F.when(F.col(name).isNotNull(), entry))).alias("_cells"))
    dense = _tiled(packed, names, [key], _parts(samples))
    cell = F.try_element_at("_cells", F.col(name))
    known = F.coalesce(cell["found"], _absent(F.col("_default_start"), F.col(date)))
    columns = [*samples.columns, name, "_logged"]
    logged = dense.select(*columns, cell["plain"].alias("_plain"), known.alias("_known"))
    others = cells.filter("plain is not null").join(names.select(name), name, "left_anti").withColumn("_logged", F.lit(False))
    return logged.unionByName(others.select(*columns, F.col("plain").alias("_plain"), F.lit(None).cast("double").alias("_known")))


def presence_counts(
    samples: DataFrame,
    obs: DataFrame,
    log: DataFrame,
    *,
    level: str,
    key: str,
    date: str,
    name: str,
    value: str,
    placeholder: str,
    by: Sequence[str],
    taxon: str = "TaxonName",
    start: str = "StartDate",
    plain_where: Column | None = None,
    affected_where: Column | None = None,
    plain_name: Column | None = None,
) -> DataFrame:
    """Samples in which a name was not looked for, absent, unknown or found, per name and ``by``; total of those found.

    What ``apply_change_log`` gives, counted by columns ``by`` of the samples, without its grid.  A
    logged name splits the samples of a group at its start date: those before did not look for it,
    those after have it absent, those on the date are unknown.  The three numbers are prefix counts
    of the group's sample dates at the start date.  Then each record moves its sample from the number
    it is in to that of its value.  Rows are dates, records, and groups by names: the result itself.

    A sample without a date is unknown, as is every sample for a name without a start date.
    """
    by = list(by)
    cells, names = _cells(
        samples, obs, log, level=level, key=key, date=date, name=name, value=value, placeholder=placeholder, taxon=taxon, start=start,
        plain_where=plain_where, affected_where=affected_where, plain_name=plain_name,
    )
    split = _split_at_starts(samples, names, date, by)
    groups = split.select(*by).distinct()
    expected = _tiled(groups, names.select(name, "_default_start"), by).alias("e").join(
        split.alias("s"), _same([*by, "_default_start"], "e", "s"),
    ).select(F.col(f"e.{name}").alias(name), *[F.col(f"e.{c}").alias(c) for c in by], "n_not_looked_for", "n_absent", "n_unknown")

    v = F.col("_value")
    was = _absent(F.col("_default_start"), F.col(date))
    known = F.coalesce("found", was)
    # most records may bear one name, such as the placeholder, and they are counted by name: its rows are spread
    records = salted_lookup(cells, names, [name], F.col(key)).withColumn("_logged", F.coalesce("_logged", F.lit(False))).filter("_logged or plain is not null")
    records = records.withColumns({"_known": known, "_was": was}).withColumn("_value", _larger("_logged", "_known", "plain"))

    def moved(test: Callable[[Column], Column]) -> Column:
        counts = [F.when(test(v), 1).otherwise(0), F.when(F.col("_logged") & test(F.col("_was")), 1).otherwise(0)]
        return F.sum(counts[0] - counts[1])

    moves = records.groupBy(name, *by).agg(
        moved(lambda x: x == NOT_LOOKED_FOR).alias("n_not_looked_for"), moved(lambda x: x == 0).alias("n_absent"),
        moved(lambda x: x.isNull()).alias("n_unknown"), F.count_if(v > 0).alias("n_found"), F.sum(F.when(v > 0, v)).alias("total"),
    )
    both = expected.unionByName(moves, allowMissingColumns=True)
    counts = ["n_not_looked_for", "n_absent", "n_unknown", "n_found"]
    return both.groupBy(name, *by).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts], F.coalesce(F.sum("total"), F.lit(0.0)).alias("total"),
    )


def _same(columns: Sequence[str], a: str, b: str) -> Column:
    """Equality of columns of two aliased tables, NULL equal to NULL."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def _split_at_starts(samples: DataFrame, names: DataFrame, date: str, by: Sequence[str]) -> DataFrame:
    """Per group and distinct start date: samples before it, after it, and the others.

    Dates are counted before anything else, and running counts are taken over the days of a group
    and over the times of a day, so no task orders all samples of a group.
    """
    dates = samples.groupBy(*by, F.col(date).cast("timestamp_ntz").alias("_t")).agg(F.count(F.lit(1)).alias("_n"), F.lit(False).alias("_asked"))
    sizes = dates.groupBy(*by).agg(F.sum("_n").alias("_size"), F.sum(F.when(F.col("_t").isNotNull(), F.col("_n")).otherwise(0)).alias("_dated"))
    asked = _tiled(sizes, names.select("_default_start").distinct(), by)
    marks = asked.select(*by, F.col("_default_start").alias("_t"), F.lit(0).cast("long").alias("_n"), F.lit(True).alias("_asked"))
    points = dates.unionByName(marks).filter(F.col("_t").isNotNull()).groupBy(*by, "_t").agg(F.sum("_n").alias("_n"), F.max("_asked").alias("_asked"))
    points = points.withColumn("_day", F.to_date("_t"))
    days = points.groupBy(*by, "_day").agg(F.sum("_n").alias("_d"))
    earlier = W.partitionBy(*by).orderBy("_day").rowsBetween(W.unboundedPreceding, -1)
    within = W.partitionBy(*by, "_day").orderBy("_t").rowsBetween(W.unboundedPreceding, -1)
    days = days.withColumn("_base", F.coalesce(F.sum("_d").over(earlier), F.lit(0)))
    inside = points.withColumn("_inside", F.coalesce(F.sum("_n").over(within), F.lit(0))).filter("_asked")
    before = inside.alias("i").join(days.alias("d"), _same([*by, "_day"], "i", "d")).select(
        *[F.col(f"i.{c}").alias(c) for c in by], F.col("_t").alias("_default_start"), "_n", (F.col("_base") + F.col("_inside")).alias("_before"),
    )
    joined = asked.alias("a").join(before.alias("b"), _same([*by, "_default_start"], "a", "b"), "left")
    n_before = F.coalesce("_before", F.lit(0))
    n_after = F.coalesce(F.col("_dated") - F.col("_before") - F.col("_n"), F.lit(0))
    return joined.select(
        *[F.col(f"a.{c}").alias(c) for c in by], F.col("a._default_start").alias("_default_start"),
        n_before.alias("n_not_looked_for"), n_after.alias("n_absent"), (F.col("_size") - n_before - n_after).alias("n_unknown"),
    )


def _larger(logged: str, known: str, plain: str) -> Column:
    """The larger part of a logged name, unknown if the logged part is; the plain part of another."""
    return F.when(~F.col(logged), F.col(plain)).when(F.col(known).isNotNull(), F.greatest(known, plain))


def group_totals(
    samples: DataFrame, obs: DataFrame, *, key: str, group: str, value: str, exclude: Sequence[str], placeholder: str,
) -> DataFrame:
    """Higher-group totals per sample, without the excluded groups."""
    totals = (
        obs.filter(not_in(F.col(group), exclude))
        .groupBy(key, group).agg(sum_or_zero(F.col(value)).alias(value))
    )
    return fill_missing_sample(samples.join(totals, key, "left"), group, value, placeholder)


def raw_long(samples: DataFrame, obs: DataFrame, *, key: str, name: str, value: str, placeholder: str | None = None) -> DataFrame:
    """Every record with its sample, and samples in which nothing was found."""
    out = keep_all_samples(samples, obs.select(key, name, value), key).select(*samples.columns, name, value)
    if placeholder is not None:
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(placeholder)))
    return out


def ids_long(samples: DataFrame, obs: DataFrame, *, key: str, taxon: str, genus: str, species: str, value: str) -> DataFrame:
    """Totals with sexes and stages binned: genus and species where the genus is known."""
    name = F.when(F.col(genus).isNull(), F.col(taxon)).otherwise(genus_species(F.col(genus), F.col(species)))
    totals = (
        obs.select(key, name.alias(taxon), value)
        .groupBy(key, taxon).agg(sum_or_zero(F.col(value)).alias(value))
    )
    return samples.join(totals, key, "left").withColumn(value, F.coalesce(F.col(value), F.lit(0.0)))


def taxon_names(long: DataFrame, name: str) -> list[str]:
    """Sorted distinct names, for the columns of a matrix: a wide table needs them before it is planned."""
    return sorted(r[0] for r in long.select(name).filter(F.col(name).isNotNull()).distinct().collect())


#: Columns of a matrix that one aggregation makes without a pivot; more would be too much code for one.
MATRIX_COLUMNS = 40


def to_matrix(
    long: DataFrame, keys: Sequence[str], name: str, value: str,
    names: Sequence[str] | None = None, fill: float = 0.0, drop_names: Sequence[str] = (),
) -> DataFrame:
    """One row per key, one column per name.

    Only absent combinations get ``fill``; a NULL in the long table stays NULL.
    Names in ``drop_names`` get no column, but their samples keep a row.
    """
    names = [n for n in (names or taxon_names(long, name)) if n not in drop_names]
    if len(names) <= MATRIX_COLUMNS:  # one row per key from the first step on: a pivot would first hold a row per key and name
        found = lambda n: F.col(name) == F.lit(n)
        wide = long.groupBy(*keys).agg(*[c for i, n in enumerate(names) for c in (F.sum(F.when(found(n), F.col(value))).alias(f"_v{i}"), F.count_if(found(n)).alias(f"_n{i}"))])
        return wide.select(*keys, *[F.when(F.col(f"_n{i}") == 0, F.lit(fill)).otherwise(F.col(f"_v{i}")).alias(n) for i, n in enumerate(names)])
    wide = long.groupBy(*keys).pivot(name, names).agg(
        F.sum(value).alias("v"), F.count(F.lit(1)).alias("n")
    )
    return wide.select(*keys, *[
        F.when(F.col(f"`{n}_n`").isNull(), F.lit(fill)).otherwise(F.col(f"`{n}_v`")).alias(n) for n in names
    ])


def taxon_totals(long: DataFrame, taxon: str, value: str) -> DataFrame:
    return long.groupBy(taxon).agg(sum_or_zero(F.col(value)).alias("total"))


def drop_zero_taxa(long: DataFrame, taxon: str, value: str) -> DataFrame:
    """Rows of taxa whose total is not 0."""
    return long.join(taxon_totals(long, taxon, value).filter("total <> 0").select(taxon), taxon, "left_semi")
