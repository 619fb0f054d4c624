"""Variable names: fallbacks, de-duplication, audit and role detection."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsvar.functions.naming import column, find_column
from obsvar.model import INDEX_COLUMN, DatasetError
from obsvar.operators.numbering import count_before, rank_in_key
from obsvar.session import materialise

# Candidate column names by role, in order of preference.
NAME_COLUMNS = (
    "gene_symbols", "gene_symbol", "gene_names", "gene_name", "symbol",
    "symbols", "feature_name", "name", "names",
)
ID_COLUMNS = ("gene_ids", "gene_id", "ensembl_id", "ensembl", "feature_id", "id", "ids")
# Content rules.
CONFIDENT_SHARE = 0.7
ID_PATTERN = "^ENS."
SYMBOL_PATTERN = "^(?=.*[A-Z])[A-Z0-9-]{2,12}$"
DIGITS_PATTERN = "^[0-9]+$"


def variable_names(var: DataFrame, name_column: str = INDEX_COLUMN) -> DataFrame:
    """``(var_idx, name)``: the chosen column as text, ``var_<i>`` where it has no value.

    A column the table does not have names every variable ``var_<i>``.
    """
    found = find_column(var.columns, name_column)
    fallback = F.concat(F.lit("var_"), F.col("var_idx").cast("string"))
    name = fallback if found is None else F.coalesce(column(found).cast("string"), fallback)
    return var.select("var_idx", name.alias("name"))


def _ancestors(name: Column) -> Column:
    """``A_1_2`` -> [A, A_1, A_1_2]: the names that can turn into this one by adding a suffix."""
    parts = F.regexp_extract_all(name, F.lit(r"(_[0-9]+)(?=(?:_[0-9]+)*$)"), F.lit(1))
    stem = F.regexp_replace(name, r"(?:_[0-9]+)+$", "")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda n: F.concat(stem, F.array_join(F.slice(parts, F.lit(1), n), "")),
    )


# a name that a repeat can turn into: a stem and a suffix as it is written
_SUFFIXED = "(?s)^(.*)_([1-9][0-9]{0,17})$"


def unique_variable_names(
    named: DataFrame, scope: Sequence[str] = (), reserved: Sequence[str] = ("obs_idx",)
) -> DataFrame:
    """``(scope, var_idx, name, unique_name)``: repeats become ``name_1``, ``name_2`` in var order.

    A suffix that is already taken is skipped. Names are compared without regard to case, because
    Spark resolves columns that way, and inside each ``scope`` (a dataset of a collection).
    Repeats of names that no other name can collide with are numbered by a ranged count. Where a
    literal name such as ``A_1`` meets repeats of ``A``, whichever comes first has it: such families
    are numbered by the gaps that their literal names leave, see ``_numbered``.
    """
    scope = list(scope)
    blocked = [r.lower() for r in reserved]
    rows = named.select(*scope, "var_idx", "name", F.lower("name").alias("_key"))
    repeated = (
        rows.groupBy(*scope, "_key")
        .agg(F.count("*").alias("_n"))
        .filter((F.col("_n") > 1) | F.col("_key").isin(blocked))
        .select(*scope, F.col("_key").alias("_family"))
    )
    # a literal suffixed name belongs to the family of its shortest repeated ancestor
    kin = (
        rows.filter(F.col("_key").rlike("_[0-9]+$"))
        .select(*scope, "_key")
        .distinct()
        .select(*scope, "_key", F.explode(_ancestors(F.col("_key"))).alias("_family"))
        .filter(F.col("_family") != F.col("_key"))
        .join(repeated, [*scope, "_family"], "left_semi")
        .groupBy(*scope, "_key")
        .agg(F.min_by("_family", F.length("_family")).alias("_family"))
    )
    out = [*scope, "var_idx", "name"]
    ranked = (F.col("_rank") + F.col("_key").isin(blocked).cast("bigint")).alias("_suffix")

    def plain(free: DataFrame) -> DataFrame:
        return _shown(rank_in_key(free, [*scope, "_key"], "var_idx", "_rank").select(*out, ranked), out)

    # names that are reserved and look like a repeat of another stand in that one's way everywhere
    stems = {m.group(1) for m in (re.match(_SUFFIXED, r) for r in blocked) if m}
    crossed = repeated.filter(F.col("_family").isin(list(stems))) if stems else repeated.filter("false")
    contested = kin.select(*scope, "_family").union(crossed).distinct()
    if contested.isEmpty():
        return plain(rows)
    contested = contested.withColumn("_contested", F.lit(True))
    tagged = (
        rows.join(kin, [*scope, "_key"], "left")
        .withColumn("_family", F.coalesce("_family", "_key"))
        .join(contested, [*scope, "_family"], "left")
        .withColumn("_contested", F.coalesce("_contested", F.lit(False)))
    )
    families = tagged.filter("_contested").select(*out, "_key")
    return plain(tagged.filter("not _contested").select(*out, "_key")).unionByName(_shown(_numbered(families, scope, blocked), out))


def _shown(rows: DataFrame, out: Sequence[str]) -> DataFrame:
    suffixed = F.concat_ws("_", "name", F.col("_suffix").cast("string"))
    return rows.select(*out, F.when(F.col("_suffix") == 0, F.col("name")).otherwise(suffixed).alias("unique_name"))


def _numbered(rows: DataFrame, scope: Sequence[str], blocked: Sequence[str]) -> DataFrame:
    """``rows`` with the suffix each name gets (0: none), by intervals between literal names.

    The j-th repeat of a stem gets j plus the number of literals it has to pass. Literal k, first
    seen at place q, is passed if the repeat whose turn it is when k comes up stands after q; that
    repeat is number k - s, s being the literals passed before. Which ones are is found by running
    counts from k = J on, J being the first repeat after q, until they agree with themselves; the
    first r literals are right after r rounds, and mostly all after the second. A literal that is
    not passed but reached has lost its name to a repeat, and is a repeat itself: stems are handled
    from the shortest on. Each step is stored, so that it is made once.
    """
    at = [*scope, "_key"]
    tail = F.regexp_extract("_key", "((?:_[1-9][0-9]{0,17})*)$", 1)
    rows = materialise(rows.withColumn("_depth", F.size(F.split(tail, "_")) - 1))
    keys = rows.groupBy(*at, "_depth").agg(F.min("var_idx").alias("_first"))
    scopes = rows.select(*scope).distinct() if scope else rows.sparkSession.range(1)
    names = F.array(*map(F.lit, blocked)).cast("array<string>")
    lost = scopes.select(*scope, F.explode(names).alias("_key"))
    held = lost.withColumn("_first", F.lit(-1).cast("bigint"))
    done, deepest = [], rows.agg(F.max("_depth")).first()[0]
    for depth in range(deepest + 1):
        mine = rows.filter(F.col("_depth") == depth).join(lost.withColumn("_lost", F.lit(1)), at, "left")
        repeat = F.col("_rank") + F.coalesce("_lost", F.lit(0))
        mine = materialise(rank_in_key(mine, at, "var_idx", "_rank").withColumn("_suffix", repeat).drop("_rank", "_lost", "_depth"))
        stems = mine.groupBy(*at).agg(F.count_if(F.col("_suffix") > 0).alias("_repeats")).filter("_repeats > 0")
        literals = keys.filter(F.col("_depth") == depth + 1).select(*at, "_first").unionByName(held.select(*at, "_first"))
        literals = literals.filter(F.col("_key").rlike(_SUFFIXED)).groupBy(*at).agg(F.min("_first").alias("_first")).select(
            *scope, F.col("_key").alias("_literal"), F.regexp_extract("_key", _SUFFIXED, 1).alias("_key"),
            F.regexp_extract("_key", _SUFFIXED, 2).cast("bigint").alias("_k"), "_first",
        ).join(stems, at)
        literals = materialise(literals)
        if literals.isEmpty():
            done.append(mine)
            continue
        events = mine.filter("_suffix > 0").select(*at, F.col("var_idx").alias("_at"), F.lit(True).alias("_mark"), F.lit(None).cast("string").alias("_literal"))
        events = events.unionByName(literals.select(*at, F.col("_first").alias("_at"), F.lit(False).alias("_mark"), "_literal"))
        earlier = count_before(events, at, "_at", F.col("_mark"), "_earlier").filter("not _mark").select(*at, "_literal", "_earlier")
        literals = literals.join(earlier, [*at, "_literal"]).withColumn("_turn", F.col("_earlier") + 1)
        passed = F.col("_turn") <= F.col("_k")
        literals = materialise(literals.withColumn("_passed", passed))
        while True:
            counted = count_before(literals, at, "_k", F.col("_passed"), "_before")
            again = materialise(counted.withColumn("_now", F.col("_turn") <= F.col("_k") - F.col("_before")))
            settled = again.filter("_now <> _passed").isEmpty()
            if settled:
                break
            literals = again.withColumn("_passed", F.col("_now")).drop("_now", "_before")
        reached = F.col("_k") - F.col("_before")
        gaps = again.filter("_passed").select(*at, reached.alias("_suffix"), F.lit(True).alias("_mark"))
        line = gaps.withColumns({"var_idx": F.lit(None).cast("bigint"), "name": F.lit(None).cast("string")}).unionByName(
            mine.filter("_suffix > 0").withColumn("_mark", F.lit(False))
        )
        moved = count_before(line, at, "_suffix", F.col("_mark"), "_gaps").filter("not _mark")
        moved = moved.withColumn("_suffix", F.col("_suffix") + F.col("_gaps")).drop("_mark", "_gaps")
        done.append(mine.filter("_suffix = 0").unionByName(moved))
        taken = again.filter(~F.col("_passed") & (reached <= F.col("_repeats"))).select(*scope, F.col("_literal").alias("_key"))
        lost = materialise(lost.unionByName(taken).distinct())
    return reduce(DataFrame.unionByName, done)


def has_repeated_names(
    named: DataFrame, scope: Sequence[str] = (), reserved: Sequence[str] = ("obs_idx",)
) -> bool:
    """Whether any name needs a suffix: one small aggregate, so that unique names skip the rest."""
    counts = named.groupBy(*scope, F.lower("name").alias("_key")).agg(F.count("*").alias("_n"))
    clash = (F.col("_n") > 1) | F.col("_key").isin([r.lower() for r in reserved])
    return not counts.filter(clash).isEmpty()


def _suffixed(names: Sequence[str], used: set[str]) -> list[str]:
    """Names in order, each repeat with the first free ``_1``, ``_2`` ...; ``used`` is lower case."""
    next_suffix, out = {}, []
    for name in names:
        key, unique = name.lower(), name
        suffix = next_suffix.get(key, 1)
        while unique.lower() in used:
            unique = f"{name}_{suffix}"
            suffix += 1
        next_suffix[key] = suffix
        used.add(unique.lower())
        out.append(unique)
    return out


def name_stems(name: str) -> list[str]:
    """``a_1_2`` -> [a_1_2, a_1, a]."""
    out = [name]
    while re.search("_[0-9]+$", out[-1]):
        out.append(out[-1].rsplit("_", 1)[0])
    return out


def resolve_variables(
    var: DataFrame, name_column: str, names: Sequence[str] | None
) -> list[tuple[int, str]]:
    """The ``(var_idx, column name)`` list of a wide scan, in one small job.

    All variables: their names, as many as the view has columns, reach the driver, where repeats get
    their suffix. Chosen
    names: one row per name and stem of it; only if one of those repeats are suffixes worked out.
    """
    named = variable_names(var, name_column)
    if names is None:
        rows = named.orderBy("var_idx").collect()
        unique = _suffixed([r.name for r in rows], {"obs_idx"})
        return [(r.var_idx, u) for r, u in zip(rows, unique)]
    names = list(dict.fromkeys(names))
    wanted = [n.lower() for n in names]
    stems = {s for n in wanted for s in name_stems(n)}
    key = F.lower("name").alias("key")
    rows = (
        named.filter(F.lower("name").isin(list(stems)))
        .groupBy(key)
        .agg(F.count("*").alias("n"), F.min("var_idx").alias("var_idx"))
        .collect()
    )
    found = {r.key: r.var_idx for r in rows}
    if "obs_idx" in stems or any(r.n > 1 for r in rows):
        unique = unique_variable_names(named).select("var_idx", F.lower("unique_name").alias("key"))
        found = {r.key: r.var_idx for r in unique.filter(F.col("key").isin(wanted)).collect()}
    missing = [n for n in names if n.lower() not in found]
    if missing:
        raise DatasetError(f"variables not found: {', '.join(missing)}")
    return [(found[n.lower()], n) for n in names]


def duplicate_name_audit(var: DataFrame, name_column: str = INDEX_COLUMN) -> DataFrame:
    """One row: how many distinct names occur more than once, and on how many variables."""
    repeated = (
        variable_names(var, name_column).groupBy("name").agg(F.count("*").alias("n")).filter("n > 1")
    )
    return repeated.agg(
        F.count("*").alias("n_duplicate_names"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_variables"),
    )


def _by_name(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    return next((f for f in (find_column(columns, c) for c in candidates) if f), None)


def role_evidence(var: DataFrame) -> DataFrame:
    """Per text column: how many of all values look like ids, symbols or plain numbers."""
    texts = [
        f.name
        for f in var.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name != INDEX_COLUMN
    ]
    values = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), column(c).alias("value"))
            for i, c in enumerate(texts)
        ]
    )
    sample = var.select(F.inline(values))
    looks_id = F.col("value").rlike(ID_PATTERN)
    return (
        sample.filter(F.col("value") != "")
        .groupBy("position", "column")
        .agg(
            F.count("*").alias("n_valid"),
            F.count_if(looks_id).alias("n_ids"),
            F.count_if(~looks_id & F.col("value").rlike(SYMBOL_PATTERN)).alias("n_symbols"),
            F.count_if(F.col("value").rlike(DIGITS_PATTERN)).alias("n_digits"),
        )
    )


def detect_roles(var: DataFrame) -> dict[str, str]:
    """Which var columns hold names and ids: known names first, then content, then ``_index``.

    By content, columns with more than 70 % matching values come first, in table order; else the
    one with most matches wins, the earlier of equal ones. Columns of mostly digits are left out.
    All values count, in one aggregate; one small row per column is collected.
    """
    name = _by_name(var.columns, NAME_COLUMNS)
    ident = _by_name(var.columns, ID_COLUMNS)
    has_text = any(
        isinstance(f.dataType, T.StringType) and f.name != INDEX_COLUMN for f in var.schema.fields
    )
    if has_text and (name is None or ident is None):
        rows = [r for r in role_evidence(var).collect() if r.n_digits < r.n_valid // 2]

        def choose(counter: str) -> str | None:
            def rank(r):
                sure = r[counter] > int(r.n_valid * CONFIDENT_SHARE)
                return (not sure, 0 if sure else -r[counter], r.position)

            best = min((r for r in rows if r[counter]), key=rank, default=None)
            return best and best["column"]

        name = name or choose("n_symbols")
        ident = ident or choose("n_ids")
    return {"var_name_column": name or INDEX_COLUMN, "var_id_column": ident or INDEX_COLUMN}
