"""The same results in plain SQL on the same tables, for checking with another engine.

Each text is written from the definition of the result, not from the plan: matrices are densified
with joins, positions come from global windows, and so on.
"""

from __future__ import annotations

from obsvar.plans.registered import GENE_SETS
from obsvar.sources.star import FLAG_MEMBERS, REST, SLICE_WIDTHS

OBS = """obs as (select s_suppkey as obs_idx, s_name as _index, n_name as cell_type, r_name as batch,
    s_acctbal as total, s_acctbal > 5000 as rich
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""
VAR = """var as (select p_partkey as var_idx, printf('G%06d', p_partkey) as _index, p_name as label,
    p_type as kind, p_brand as brand, p_size as size, p_retailprice as price,
    p_size >= 40 as highly_variable from part)"""
X = """x as (select l_suppkey as obs_idx, l_partkey as var_idx, sum(l_quantity) as value,
    count(*) as n, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as price
  from lineitem group by all)"""
PANEL_OBS = """obs as (select o_orderkey as obs_idx, o_orderstatus as status,
    o_orderpriority as priority from orders)"""
PANEL_X = """x as (select l_orderkey as obs_idx, cast(substr(p_brand, 7) as bigint) - 1 as var_idx,
    sum(l_quantity) as value, cast(count(*) as integer) as n
  from lineitem join part on l_partkey = p_partkey group by all)"""
PANEL_VAR = """var as (select distinct cast(substr(p_brand, 7) as bigint) - 1 as var_idx,
    p_brand as _index from part)"""


def _lead(item: str, axis: str, where: str = "true", extra: str = "") -> str:
    return f"""(with items as (select distinct l_orderkey, {item} as i from lineitem where {where}),
    lead as (select l_orderkey, min(i) as lead from items group by 1)
  select {extra}lead as {axis}_1, i as {axis}_2, cast(count(*) as double) as value
  from items join lead using (l_orderkey) where i <> lead group by all)"""


def _wide(rows: str, cells: str, value: str, columns: list[tuple[int, str]], cast: str,
          keys: tuple[str, ...] = ("obs_idx",)) -> str:
    aggregates = ", ".join(
        f'coalesce(max({value}) filter (where var_idx = {i}), cast(0 as {cast})) as "{n}"'
        for i, n in columns
    )
    on = " and ".join(f"o.{k} = c.{k}" for k in keys)
    listed = ", ".join(f"o.{k}" for k in keys)
    return f"select {listed}, {aggregates} from {rows} o left join {cells} c on {on} group by {listed}"


def _r(expression: str, name: str) -> str:
    return f"round(cast({expression} as double), 6) as {name}"


BRAND_COLUMNS = [(i, f"Brand#{i + 1}") for i in range(25)]
SIZE_COLUMNS = [(i, f"SIZE_{i + 1:02d}") for i in range(50)]

SQL: dict[str, str] = {
    "scan_obs": f"with {OBS} select obs_idx, _index, cell_type, batch, {_r('total', 'total')}, rich from obs",
    "scan_var": f"with {VAR} select * exclude (price), {_r('price', 'price')} from var",
    "scan_x_wide": f"with {PANEL_OBS}, {PANEL_X} " + _wide("obs", "x", "value", BRAND_COLUMNS, "double"),
    "scan_x_named": f"with {PANEL_OBS}, {PANEL_X} "
    + _wide("obs", "x", "value", [(i, f"ENSB{i:05d}") for i in range(25)], "double"),
    "scan_x_long": f"with {X} select obs_idx, var_idx, printf('G%06d', var_idx) as var_name, value from x",
    "scan_x_vector": f"""with {X} select s_suppkey as obs_idx,
      cast((select count(*) from part) as integer) as width,
      coalesce(sum(value * (var_idx + 1)), cast(0 as double)) as weighted_sum
      from supplier left join x on obs_idx = s_suppkey group by s_suppkey""",
    "scan_layer": f"with {PANEL_OBS}, {PANEL_X} " + _wide("obs", "x", "n", BRAND_COLUMNS, "integer"),
    "scan_obsm": "select vec_id as obs_idx, "
    + ", ".join(_r(f"embedding[{i + 1}]", f'"X_emb_{i}"') for i in range(64))
    + " from embeddings",
    "scan_varm": f"""select p_partkey as var_idx, cast(p_size as double) as stats_0,
      {_r('p_retailprice', 'stats_1')} from part""",
    "scan_obsp": f"select * from {_lead('l_suppkey', 'obs_idx')}",
    "scan_varp": f"select * from {_lead('l_partkey', 'var_idx')}",
    "scan_raw_x": """with x as (select l_suppkey as obs_idx, p_size - 1 as var_idx, sum(l_quantity) as value
      from lineitem join part on l_partkey = p_partkey group by all),
      obs as (select s_suppkey as obs_idx from supplier) """
    + _wide("obs", "x", "value", SIZE_COLUMNS, "double"),
    "scan_raw_var": f"""select cast(p_size - 1 as bigint) as var_idx, printf('SIZE_%02d', p_size) as _index,
      count(*) as n_parts, {_r('sum(cast(p_retailprice as decimal(18,2)))', 'price')}
      from part group by p_size""",
    "scan_raw_varm": f"""select cast(p_size - 1 as bigint) as var_idx, cast(count(*) as double) as profile_0,
      {_r('sum(cast(p_retailprice as decimal(18,2)))', 'profile_1')} from part group by p_size""",
    "dataset_info": """with n as (select (select count(*) from supplier)::varchar as o,
        (select count(distinct p_size) from part where p_size <= 25)::varchar as v,
        (select count(distinct p_size) from part)::varchar as rv)
      select 'n_obs' as property, o as value from n union all select 'n_vars', v from n
      union all select 'x_shape', o || ' x ' || v from n union all select 'x_sparse', 'true'
      union all select 'x_format', 'csr' union all select 'groups', 'obs, var, X'
      union all select 'tables', 'obs, var, info, X' union all select 'var_name_column', '_index'
      union all select 'var_id_column', '_index' union all select 'raw', 'true'
      union all select 'raw_n_vars', rv from n union all select 'raw_x_shape', o || ' x ' || rv from n
      union all select 'raw_x_sparse', 'true' union all select 'raw_x_format', 'csr'
      union all select 'raw_varm_keys', 'profile'""",
    "multi_file_scan": """select 'part.parquet' as _file_name, p_partkey as key, p_name as name from part
      union all select 'supplier.parquet', s_suppkey, s_name from supplier
      union all select 'customer.parquet', c_custkey, c_name from customer""",
    "external_annotation": f"""with {VAR}, notes as (select 'Brand#' || (2 * s_nationkey + 1) as brand,
        min(s_name) as pathway, count(*) as n_terms from supplier group by 1)
      select var.* exclude (price), {_r('price', 'price')}, pathway, n_terms
      from var left join notes using (brand)""",
    "coo_to_csr": f"""with {X}, rows as (select s_suppkey as r, count(x.value) as n
        from supplier left join x on x.obs_idx = s_suppkey group by 1),
      starts as (select r, cast(sum(n) over (order by r) - n as bigint) as start from rows)
      select 'indptr' as section, r as pos, start as idx, cast(null as double) as val from starts
      union all select 'indptr', (select max(r) + 1 from rows), (select cast(sum(n) as bigint) from rows), null
      union all select 'entries', row_number() over (order by obs_idx, var_idx) - 1, var_idx, value from x""",
    "csr_to_coo": f"with {X} select obs_idx, var_idx, value from x",
    "csc_to_coo": f"with {X} select obs_idx, var_idx, value from x",
    "positions_to_coo": f"with {X} select obs_idx, var_idx, value from x",
    "csr_slice": f"""with {X} select obs_idx, var_idx, value from x, (select count(*) as k from supplier)
      where obs_idx >= k // 4 and obs_idx < k // 4 + k // 2""",
    "csr_csc_equal": f"""with {X} select count(*) as n_cells, count(*) as n_equal,
      cast(0 as bigint) as n_one_sided, cast(0 as bigint) as n_different from x""",
    "densify": """with x as (select l_suppkey as obs_idx, p_size - 1 as var_idx, sum(l_quantity) as value
      from lineitem join part on l_partkey = p_partkey group by all),
      sizes as (select distinct cast(p_size - 1 as bigint) as var_idx from part)
      select s_suppkey as obs_idx, sizes.var_idx, coalesce(value, cast(0 as double)) as value
      from supplier cross join sizes left join x on x.obs_idx = s_suppkey and x.var_idx = sizes.var_idx""",
    "dense_to_long": f"""select vec_id as obs_idx, cast(i - 1 as bigint) as var_idx, {_r('embedding[i]', 'value')}
      from embeddings, unnest(generate_series(1, len(embedding))) as u(i)""",
    "nonzero_long": f"with {X} select obs_idx, var_idx, {_r('ln(1 + value)', 'value')} from x where value > 0",
    "project_genes": f"with {PANEL_X} select obs_idx, var_idx, value from x where var_idx in (2, 10, 24)",
    "obs_slice": f"""with {PANEL_X} select obs_idx, var_idx, value from x, (select count(*) as k from orders)
      where obs_idx >= k // 4 and obs_idx < k // 4 + k // 2""",
    "matrix_shape": f"""with {X} select (select count(*) from supplier) as n_obs,
      (select count(*) from part) as n_var, count(*) as n_cells, 'csr' as format from x""",
    "assign_index": """select o_custkey, o_orderkey,
      row_number() over (order by o_custkey, o_orderkey) - 1 as obs_idx from orders""",
    "categorical_encode": f"""with {VAR}, v as (select var_idx, case when size % 10 <> 0 then label end as label
      from var), c as (select label, row_number() over (order by label) - 1 as code
      from (select distinct label from v where label is not null))
      select var_idx as idx, cast(coalesce(code, -1) as integer) as code, label from v left join c using (label)""",
    "categorical_decode": f"""with {VAR}
      select 'label' as source, var_idx as idx, case when var_idx % 97 <> 0 then label end as label from var
      union all select 'size', var_idx, case when var_idx % 97 <> 0 then cast(size as varchar) end from var
      union all select 'price', var_idx, case when var_idx % 97 <> 0 then printf('%.6f', price) end from var""",
    "bool_render": f"""with {VAR} select var_idx,
      case when highly_variable then 'True' else 'False' end as highly_variable from var""",
    "record_flatten": f"with {VAR} select var_idx, _index, label, size, {_r('price', 'price')} from var",
    "dedup_columns": f"""with {VAR} select var_idx, label as "Label", kind as label_, brand as "LABEL__" from var""",
    "dup_var_names": f"""with {VAR}, k as (select var_idx, label,
        row_number() over (partition by label order by var_idx) - 1 as r from var)
      select var_idx, case when r = 0 then label else label || '_' || r end as unique_name from k""",
    "dup_name_audit": f"""with {VAR}, k as (select label, count(*) as n from var group by 1 having count(*) > 1)
      select count(*) as n_duplicate_names, cast(sum(n) as bigint) as n_variables from k""",
    "var_names": f"""with {VAR} select var_idx,
      coalesce(case when size % 7 <> 0 then label end, 'var_' || var_idx) as name from var""",
    "detect_roles": f"""with {VAR}, s as (unpivot (select var_idx, label, kind, brand from var)
        on label, kind, brand into name "column" value v),
      e as (select "column", count(*) as n_valid, count(*) filter (v like 'ENS_%') as n_ids,
          count(*) filter (v not like 'ENS_%' and regexp_full_match(v, '[A-Z0-9-]{{2,12}}')
            and regexp_matches(v, '[A-Z]')) as n_symbols,
          count(*) filter (regexp_full_match(v, '[0-9]+')) as n_digits from s where v <> '' group by 1)
      select *, "column" = 'kind' as is_name, false as is_id from e""",
    "alignment_check": f"""with {X} select (select count(*) from supplier) as n_obs_metadata,
      count(distinct obs_idx) as n_obs_matrix, (select count(*) from part) as n_var_metadata,
      count(distinct var_idx) as n_var_matrix,
      count(distinct obs_idx) filter (obs_idx not in (select s_suppkey from supplier)) as n_obs_out_of_range,
      count(distinct var_idx) filter (var_idx not in (select p_partkey from part)) as n_var_out_of_range from x""",
}

# --- metadata trees ---------------------------------------------------------------------------

EVENTS = """e as (select event_type as dataset, value, user_id, hour(ts) as h,
    cast(json_extract_string(props, '$.k') as integer) as k from events),
  t as (select dataset, count(*) as n,
    cast(sum(cast(value as decimal(18,2))) as double) / count(*) as mean, max(value) as max,
    count(distinct user_id) as n_users, max(k) as k_max from e group by 1),
  hours as (select dataset, u.h, count(*) filter (e.h = u.h) as n
    from e, unnest(generate_series(0, 23)) as u(h) group by all),
  hist as (select dataset, string_agg(h::varchar, ',' order by h) as hours,
    string_agg(n::varchar, ',' order by h) as counts from hours group by 1),
  cells as (select dataset, q, m, count(*) filter (e.h // 6 = q and e.k % 3 = m) as n
    from e, unnest(generate_series(0, 3)) as a(q), unnest(generate_series(0, 2)) as b(m) group by all),
  grid as (select dataset, string_agg(n::varchar, ',' order by q, m) as grid from cells group by 1)"""


def _leaves(small_int: str) -> str:
    rows = [
        ("title", "scalar", "string", "()", "upper(dataset)", "null"),
        ("stats/n", "scalar", "int64", "()", "n::varchar", "null"),
        ("stats/mean", "scalar", "float64", "()", "printf('%.6g', mean)", "null"),
        ("stats/max", "scalar", "float64", "()", "printf('%.6g', max)", "null"),
        ("stats/spread", "scalar", "bool", "()", "(max > 350)::varchar", "null"),
        ("params/limits/n_users", "scalar", "int64", "()", "n_users::varchar", "null"),
        ("params/limits/k_max", "scalar", small_int, "()", "k_max::varchar", "null"),
        ("params/rate", "scalar", "float64", "()", "'0.1'", "null"),
        ("hist/hours", "array", small_int, "(24)", "null", "hours"),
        ("hist/counts", "array", "int64", "(24)", "null", "counts"),
        ("grid", "array", "int64", "(4, 3)", "null", "grid"),
    ]
    selects = " union all ".join(
        f"select dataset, '{k}' as key, '{t}' as type, '{d}' as dtype, '{s}' as shape, "
        f"{v}::varchar as scalar, {a}::varchar as arr from whole"
        for k, t, d, s, v, a in rows
    )
    return f"with {EVENTS}, whole as (select * from t join hist using (dataset) join grid using (dataset)) {selects}"


SQL |= {
    "scan_uns": _leaves("int32"),
    "uns_flatten": _leaves("int64"),
    "uns_access": f"""select dataset, key, type, dtype, shape,
      case type when 'array' then 'arr' else 'scalar' end as tag, scalar,
      cast(case when type = 'array' then len(string_split(arr, ',')) end as integer) as arr_len
      from ({_leaves('int32')})""",
    "uns_tree": f"""with l as ({_leaves('int32')}), p as (select *, string_split(key, '/') as s from l)
      select distinct dataset, array_to_string(s[1:i], '/') as path, array_to_string(s[1:i - 1], '/') as parent_path,
        s[i] as name, case when i = len(s) then 'dataset' else 'group' end as node_type,
        case when i = len(s) then dtype end as dtype, case when i = len(s) then shape end as shape
      from p, unnest(generate_series(1, len(s))) as u(i)""",
    "uns_scalars": f"""select dataset, key, scalar as value from ({_leaves('int32')})
      where type = 'scalar' and key like 'params/%'""",
    "uns_array": f"""with {EVENTS} select dataset, cast(h as integer) as index, n::varchar as value from hours""",
    "uns_table": f"""with {EVENTS} select dataset, cast(h as integer) as index, h::varchar as hours,
      n::varchar as counts from hours""",
    "uns_json": f"""with {EVENTS} select dataset,
      '{{"n_users":' || n_users || ',"k_max":' || k_max || '}}' as json from t""",
    "var_array_table": """with s as (select distinct cast(substr(p_brand, 7) as bigint) - 1 as var_idx,
        p_size as value from part)
      select var_idx, cast(row_number() over (partition by var_idx order by value) - 1 as integer) as index,
        value from s""",
}

# --- collections ------------------------------------------------------------------------------

MEMBERS = list(FLAG_MEMBERS.items())
METRICS = [m for _, (_, _, m) in MEMBERS]


def _member_obs(flag: str, metrics: bool) -> str:
    grade = {
        "A": "cast(s_nationkey as varchar)", "N": "'n' || s_nationkey", "R": "cast(s_nationkey > 12 as varchar)"
    }[flag]
    own = "".join(
        ", " + (f"coalesce(round(m.metric, 6), 0)::double as {x}" if x == FLAG_MEMBERS[flag][2]
                else f"null::double as {x}")
        for x in METRICS
    ) if metrics else ""
    return f"""select 'flag_{flag}' as _file_name, s_suppkey as obs_idx, n_name as cell_type,
      'flag_{flag}' as sample_id, cast(coalesce(m.n, 0) as double) as n_lines, {grade} as grade{own}
      from supplier join nation on s_nationkey = n_nationkey left join (select l_suppkey, count(*) as n,
        cast(sum(cast(l_discount as decimal(18,2))) as double) as metric
        from lineitem where l_returnflag = '{flag}' group by 1) m on l_suppkey = s_suppkey"""


def _all_obs(metrics: bool = False) -> str:
    return " union all ".join(_member_obs(f, metrics) for f, _ in MEMBERS)


def _own(low: int, high: int) -> str:
    return f"case when p_size between {low} and {high} then p_size else {REST} end"


FLAG_X = "x as (" + " union all ".join(
    f"""select 'flag_{f}' as _file_name, l_suppkey as obs_idx, {_own(lo, hi)} as var_idx, sum(l_quantity) as value,
    cast(count(*) as integer) as n from lineitem join part on l_partkey = p_partkey
    where l_returnflag = '{f}' group by all"""
    for f, (lo, hi, _) in MEMBERS
) + ")"
FLAG_OBS = "obs as (" + " union all ".join(
    f"select 'flag_{f}' as _file_name, s_suppkey as obs_idx from supplier" for f, _ in MEMBERS
) + ")"
COMMON = list(range(max(lo for _, (lo, _, _) in MEMBERS), min(hi for _, (_, hi, _) in MEMBERS) + 1)) + [REST]
FILE_KEYS = ("_file_name", "obs_idx")


def _flag_wide(value: str, cast: str) -> str:
    columns = [(s, f"SIZE_{s:02d}") for s in COMMON]
    return _wide("obs", "x", value, columns, cast, FILE_KEYS)


def _flag_union(sizes: list[int]) -> str:
    def having(size: int) -> str:
        return ", ".join(f"'flag_{f}'" for f, (lo, hi, _) in MEMBERS if lo <= size <= hi or size == REST)

    columns = ", ".join(
        f"""case when o._file_name in ({having(s)}) then
        coalesce(max(value) filter (where var_idx = {s}), cast(0 as double)) end as "SIZE_{s:02d}\""""
        for s in sizes
    )
    return f"""with {FLAG_X}, {FLAG_OBS} select o._file_name, o.obs_idx, {columns} from obs o left join x c
      on o._file_name = c._file_name and o.obs_idx = c.obs_idx group by o._file_name, o.obs_idx"""


def _flag_vars(select: str) -> str:
    return " union all ".join(
        f"""select 'flag_{f}' as _file_name, cast(if(sz = {REST}, {hi - lo + 1}, sz - {lo}) as bigint) as var_idx, {select.format(
            size='sz', index=f'if(sz = {REST}, {hi - lo + 1}, sz - {lo})', flag=f, price="round(cast(sum(cast(p_retailprice as decimal(18,2))) as double), 6)",
            shown=1 if f == 'A' else 0, width={'A': 1, 'N': 2, 'R': 3}[f])}
        from (select *, {_own(lo, hi)} as sz from part) group by sz"""
        for f, (lo, hi, _) in MEMBERS
    )


SQL |= {
    "file_name_counts": f"""select _file_name, count(*) as n_rows, count(metric_alpha) as n_alpha
      from ({_all_obs(True)}) group by 1""",
    "harmonize_obs_intersection": _all_obs(),
    "harmonize_obs_union": _all_obs(True),
    "coerce_types": f"select _file_name, obs_idx, n_lines, grade from ({_all_obs()})",
    "harmonize_var": _flag_vars(
        "printf('SIZE_%02d', {size}) as _index, count(*) as n_parts, case when {shown} = 1 then {price} end as price"
    ),
    "harmonize_varm": _flag_vars(
        "cast(count(*) as double) as stats_0, case when {width} > 1 then {price} end as stats_1, "
        "case when {width} > 2 then cast(min({index}) as double) end as stats_2"
    ),
    "harmonize_x_intersection": f"with {FLAG_X}, {FLAG_OBS} " + _flag_wide("value", "double"),
    "harmonize_layer": f"with {FLAG_X}, {FLAG_OBS} " + _flag_wide("n", "integer"),
    "harmonize_x_union": _flag_union([*range(1, 51), REST]),
    "project_genes_multi": _flag_union([5, 25, 45]),
    "harmonize_long": f"""with {FLAG_X} select _file_name, obs_idx, printf('SIZE_%02d', var_idx) as var_name, value
      from x where var_idx in ({', '.join(map(str, COMMON))})""",
    "harmonize_obsm_min": " union all ".join(
        f"select '{n}' as _file_name, vec_id as obs_idx, "
        + ", ".join(_r(f"embedding[{i + 1}]", f'"X_pca_{i}"') for i in range(min(SLICE_WIDTHS.values())))
        + " from embeddings"
        for n in SLICE_WIDTHS
    ),
    "harmonize_obsm_max": " union all ".join(
        f"select '{n}' as _file_name, vec_id as obs_idx, "
        + ", ".join(
            _r(f"embedding[{i + 1}]" if i < k else "null", f'"X_pca_{i}"')
            for i in range(max(SLICE_WIDTHS.values()))
        )
        + " from embeddings"
        for n, k in SLICE_WIDTHS.items()
    ),
    "obsp_concat": " union all ".join(
        f"select * from {_lead('l_suppkey', 'obs_idx', f'l_returnflag = {chr(39)}{f}{chr(39)}', f'{chr(39)}flag_{f}{chr(39)} as _file_name, ')}"
        for f, _ in MEMBERS
    ),
    "varp_concat": " union all ".join(
        f"select * from {_lead('l_partkey', 'var_idx', f'l_returnflag = {chr(39)}{f}{chr(39)}', f'{chr(39)}flag_{f}{chr(39)} as _file_name, ')}"
        for f, _ in MEMBERS
    ),
    "file_composition": f"""select _file_name, cell_type, count(*) as n_cells from ({_all_obs()}) group by all""",
    "cohort_counts": " union all ".join(
        f"""select 'flag_{f}' as _file_name, (select count(*) from supplier) as n_obs,
        (select count(distinct {_own(lo, hi)}) from part) as n_vars"""
        for f, (lo, hi, _) in MEMBERS
    ),
    "cross_file_expr": f"""with {FLAG_X}, n as (select count(*) as n from supplier),
      grid as (select f as _file_name, i as var_idx from unnest([{', '.join(f"'flag_{f}'" for f, _ in MEMBERS)}]) as u(f), unnest({COMMON}) as c(i))
      select g._file_name, printf('SIZE_%02d', g.var_idx) as var_name,
        round(coalesce(sum(value), 0) / max(n.n), 6) as mean_expr
      from n, grid g left join x on x._file_name = g._file_name and x.var_idx = g.var_idx group by all""",
    "cross_file_join": f"""with {FLAG_X}, {FLAG_OBS}, w as ({_flag_wide('value', 'double')}),
      o as (select s_suppkey as obs_idx, n_name as cell_type from supplier join nation on s_nationkey = n_nationkey)
      select w._file_name, o.cell_type, {', '.join(_r(f'avg("SIZE_{s:02d}")', f'"mean_SIZE_{s:02d}"') for s in COMMON)}
      from w join o on w.obs_idx = o.obs_idx group by all""",
}

# --- analytics --------------------------------------------------------------------------------

GRID = "grid as (select obs_idx, cell_type, batch, var_idx from obs cross join var)"


def _top(select: str, order: str, limit: int) -> str:
    return f"{select} order by {order} desc nulls last, var_idx limit {limit}"


SETS = "sets(set_name, _index) as (values " + ", ".join(
    f"('{s}', '{g}')" for s, genes in GENE_SETS.items() for g in genes
) + ")"
LAYERS = f"""with {X}, l as (select 'counts' as layer, cast(n as double) as v from x
  union all select 'lognorm', ln(1 + value) from x union all select 'price', price from x)"""

SQL |= {
    "qc_cell_metrics": f"""with {OBS}, {X}, s as (select obs_idx, count(*) as n_genes_expressed,
        sum(value) as total_counts, avg(value) as mean_expression from x where value > 0 group by 1)
      select obs_idx, _index, cell_type, batch, round(total, 6) as total, rich, n_genes_expressed,
        round(total_counts, 6) as total_counts, round(mean_expression, 6) as mean_expression
      from obs join s using (obs_idx) where n_genes_expressed > 200 and n_genes_expressed < 2500""",
    "expr_by_group": f"""with {PANEL_OBS}, {PANEL_VAR}, {PANEL_X}, cells as (select o.priority, v._index,
        coalesce(x.value, cast(0 as double)) as value from obs o cross join var v
        left join x on x.obs_idx = o.obs_idx and x.var_idx = v.var_idx)
      select priority, _index as gene, round(avg(value), 6) as mean_expr, round(stddev(value), 6) as std_expr,
        count(*) as n_cells from cells group by all""",
    "expr_by_group_nonzero": f"""with {OBS}, {X} select cell_type, var_idx, round(avg(value), 6) as mean_expr,
      round(stddev(value), 6) as std_expr, count(*) as n_cells from x join obs using (obs_idx)
      where value <> 0 group by all""",
    "diff_expr": f"""with {OBS}, {X}, s as (select var_idx,
        sum(case when batch = 'AFRICA' then value else 0 end) as l,
        sum(case when batch = 'ASIA' then value else 0 end) as r
        from x join obs using (obs_idx) group by 1),
      m as (select var_idx, l / (select count(*) from obs where batch = 'AFRICA') as ml,
        r / (select count(*) from obs where batch = 'ASIA') as mr from s),
      c as (select *, log10(ml + 0.001::double) - log10(mr + 0.001::double) as lfc from m)
      select var_idx, printf('G%06d', var_idx) as gene, {_r('ml', 'mean_left')}, {_r('mr', 'mean_right')},
        {_r('lfc', 'log_fold_change')} from ({_top('select * from c where abs(lfc) > 1', 'lfc', 50)})""",
    "embedding_metadata": f"""select vec_id as obs_idx, cast(label as varchar) as cell_type,
      {_r('embedding[1]', '"X_emb_0"')}, {_r('embedding[2]', '"X_emb_1"')}, {_r('embedding[64]', '"X_emb_63"')}
      from embeddings""",
    "cluster_composition": f"""with {PANEL_OBS} select status, priority, count(*) as n_cells,
      {_r('count(*) * 100.0::double / sum(count(*)) over (partition by status)', 'pct_of_cluster')}
      from obs group by status, priority""",
    "cluster_markers": f"""with {OBS}, {VAR}, {X}, {GRID}, e as (select g.batch, g.var_idx,
        avg(coalesce(x.value, cast(0 as double))) as m,
        count(case when x.value > 0 then 1 end) * 100.0::double / count(*) as p
        from grid g left join x on x.obs_idx = g.obs_idx and x.var_idx = g.var_idx group by all)
      select batch, var_idx, {_r('m', 'mean_expr')}, {_r('p', 'pct_expressed')} from e where p > 25""",
    "layer_compare": f"""with {X} select obs_idx, var_idx, cast(n as integer) as counts,
      {_r('ln(1 + value)', 'lognorm')}, {_r('price', 'price')} from x where n > 0""",
    "layer_stats": f"""{LAYERS} select layer, count(*) as n_nonzero, {_r('avg(v)', 'mean_value')},
      {_r('max(v)', 'max_value')} from l where v > 0 group by 1""",
    "trajectory": f"""select vec_id as obs_idx, cast(label as varchar) as cell_type,
      {_r('embedding[1]', 'pseudotime')}, {_r('embedding[4]', '"X_diff_0"')}, {_r('embedding[5]', '"X_diff_1"')},
      {_r('embedding[2]', '"X_map_0"')}, {_r('embedding[3]', '"X_map_1"')} from embeddings""",
    "multi_sample_stats": f"""with {OBS}, {VAR}, {X} select cell_type, batch, var_idx,
      {_r('avg(value)', 'mean_expression')}, {_r('stddev(value)', 'std_expression')},
      count(distinct obs_idx) as n_cells from x join obs using (obs_idx)
      where var_idx in (select var_idx from var where highly_variable) group by all""",
    "batch_effect": f"""with {OBS}, {VAR}, {X}, b as (select batch, count(*) as n from obs group by 1),
      m as (select b.batch, v.var_idx, coalesce(sum(s.value), 0) / max(b.n) as m from b cross join var v
        left join (select batch, var_idx, value from x join obs using (obs_idx)) s
        on s.batch = b.batch and s.var_idx = v.var_idx group by all),
      d as (select var_idx, max(m) - min(m) as diff, stddev(m) as sd from m group by 1
        having count(distinct batch) > 1)
      select var_idx, {_r('diff', 'max_batch_difference')}, {_r('sd', 'batch_std')}
      from ({_top('select * from d', 'diff', 20)})""",
    "gene_set_score": f"""with {PANEL_OBS}, {PANEL_VAR}, {PANEL_X}, {SETS},
      s as (select obs_idx, set_name, sum(value) as v from x join var using (var_idx) join sets using (_index)
        group by all),
      k as (select set_name, count(*) as k from sets group by 1)
      select o.obs_idx, k.set_name, round(coalesce(s.v, 0) / k.k, 6) as set_score
      from obs o cross join k left join s on s.obs_idx = o.obs_idx and s.set_name = k.set_name""",
    "gene_set_score_many": f"""with {OBS}, {VAR}, {X},
      k as (select kind, count(*) as k from var group by 1),
      s as (select obs_idx, kind, sum(value) as v from x join var using (var_idx) group by all)
      select o.obs_idx, k.kind as set_name, round(coalesce(s.v, 0) / k.k, 6) as set_score
      from obs o cross join k left join s on s.obs_idx = o.obs_idx and s.kind = k.kind""",
    "scan_x_wide_many": f"""with {OBS}, {X} select obs.obs_idx, (select count(*)::integer from part) as n_columns,
        (count(*) filter (value > 0))::integer as n_stored, coalesce(sum(value), 0)::double as total
      from obs left join x using (obs_idx) group by obs.obs_idx""",
    "matrix_format": """with n as (select (select count(*) from supplier) as o, (select count(*) from part) as v)
      select o + 1 as n_starts, o as n_obs, v as n_var, 'csr' as format, 'obs_idx' as axis from n
      union all select v + 1, o, v, 'csc', 'var_idx' from n""",
    "harmonize_x_union_case": f"with {PANEL_OBS}, {PANEL_X}, w as ("
    + _wide("obs", "x", "value", [(i, f"c{i}") for i in range(25)], "double")
    + ") select 'big' as _file_name, obs_idx, "
    + ", ".join(f'c{i} as "BRAND#{i + 1}"' for i in range(25)) + ", "
    + ", ".join(f'null::double as "brand#{i + 1}_1"' for i in range(25))
    + " from w union all select 'small', obs_idx, " + ", ".join(["null"] * 25) + ", "
    + ", ".join(f"c{i}" for i in range(25)) + " from w",
    "uns_mixed": """with e as (select event_type, count(*) % 1000 as k from events group by 1)
      select event_type, 'mixed' as key, 'array' as type, 'string' as dtype, '(3)' as shape,
        [k::varchar, k || '.5', event_type] as arr from e
      union all select event_type, 'real', 'array', 'float64', '(2)', [k::varchar, k || '.5'] from e
      union all select event_type, 'ragged', 'array', 'string', '(2)', ['[' || k || ']', '[1,2]'] from e""",
    "matrix_density": f"""with {X}, n as (select (select count(*) from supplier) * (select count(*) from part) as n)
      select max(n.n) as total_entries, count(*) filter (value > 0) as nonzero_entries,
        round(count(*) filter (value > 0) * 100.0::double / max(n.n), 6) as density_pct from x, n""",
    "marked_fraction": f"""with {VAR}, {X}, s as (select obs_idx, count(distinct var_idx) filter (value > 0) as n,
        sum(value) as t, sum(value) filter (kind like 'ECO%') as m from x join var using (var_idx) group by 1)
      select s_suppkey as obs_idx, coalesce(n, 0) as n_genes, round(coalesce(t, 0), 6) as total_counts,
        round(coalesce(m, 0) / nullif(t, 0), 6) as marked_fraction
      from supplier left join s on s.obs_idx = s_suppkey""",
    "top_features": f"""with {VAR}, {X}, s as (select var_idx, count(*) filter (value > 0) as n_cells,
        sum(value) / (select count(*) from supplier) as m from x
        where var_idx in (select var_idx from var where highly_variable) group by 1)
      select var_idx, n_cells, round(m, 6) as mean_counts from ({_top('select * from s', 'm', 20)})""",
    "high_expr_genes": f"""with {X}, s as (select var_idx, sum(value) / (select count(*) from supplier) as m
        from x group by 1 having m > 1)
      select var_idx, round(m, 6) as mean_counts from ({_top('select * from s', 'm', 20)})""",
    "annotated_long": f"""with {OBS}, {VAR}, {X} select obs_idx, var_idx, value, cell_type, batch, label,
      round(var.price, 6) as price from x join obs using (obs_idx) join var using (var_idx) where value > 0""",
    "pair_annotate": f"""with {OBS} select p.obs_idx_1, a.cell_type as cell_type_1, p.obs_idx_2,
      b.cell_type as cell_type_2, p.value from {_lead('l_suppkey', 'obs_idx')} p
      join obs a on a.obs_idx = p.obs_idx_1 join obs b on b.obs_idx = p.obs_idx_2""",
    "pair_stats": f"""select count(*) as n_pairs, min(obs_idx_1) as min_idx_1, max(obs_idx_1) as max_idx_1,
      min(obs_idx_2) as min_idx_2, max(obs_idx_2) as max_idx_2, {_r('avg(value)', 'avg_value')},
      cast(avg(value) as integer) as avg_rounded, count(*) filter (value < 0) as n_negative
      from {_lead('l_suppkey', 'obs_idx')}""",
    "export_long": f"""with {OBS}, {VAR}, {X} select obs_idx, var_idx, value, cell_type, batch, label
      from x join obs using (obs_idx) join var using (var_idx) where value > 0""",
    "validate_dataset": """select 'obs' as component, count(*) as n_rows, true as valid, 'ok' as message
      from supplier union all select 'var', count(*), true, 'ok' from part""",
    "component_inventory": f"""with {X}, n as (select (select count(*) from x)::varchar || ' stored' as x,
        (select count(*) from supplier)::varchar as o, (select count(*) from part)::varchar as v,
        (select count(*) from {_lead('l_suppkey', 'obs_idx')})::varchar || ' stored' as op,
        (select count(*) from {_lead('l_partkey', 'var_idx')})::varchar || ' stored' as vp)
      select 'obs' as component, 'table' as type, o as shape, true as usable from n
      union all select 'var', 'table', v, true from n union all select 'X', 'matrix', x, true from n
      union all select 'layers_counts', 'matrix', x, true from n
      union all select 'layers_lognorm', 'matrix', x, true from n
      union all select 'layers_price', 'matrix', x, true from n
      union all select 'varm_stats', 'dense', v || ' x 2', true from n
      union all select 'obsp_lead', 'pairs', op, true from n
      union all select 'varp_lead', 'pairs', vp, true from n""",
}

# --- collections: names by case, unlike metadata ----------------------------------------------

_NAMED = (("Brand#3", 2), ("brand#11", 10), ("BRAND#25", 24))


def _uns_multi() -> str:
    def leaf(kinds, key, dtype, text, type_="scalar", shape="()", arr="null"):
        listed = ", ".join(f"'{k}'" for k in kinds)
        return (
            f"select dataset || '.data' as _file_name, '{key}' as key, '{type_}' as type, '{dtype}' as dtype, '{shape}' as shape, "
            f"{text}::varchar as scalar, {arr}::varchar as arr from whole where dataset in ({listed})"
        )

    rows = [
        leaf(("click", "error", "purchase", "signup"), "stats/n", "float64", "printf('%.6g', n::double)"),
        leaf(("error",), "stats/max", "float64", "printf('%.6g', max)"),
        leaf(("click",), "title", "string", "upper(dataset)"),
        leaf(("error",), "params/limits/n_users", "int64", "n_users"),
        leaf(("error",), "params/limits/k_max", "int32", "k_max"),
        leaf(("error", "view"), "params/rate", "string", "'0.1'"),
        leaf(("view",), "hist/hours", "int32", "null", "array", "(24)", "hours"),
        leaf(("view",), "hist/counts", "int64", "null", "array", "(24)", "counts"),
        leaf(("purchase", "signup"), "grid", "int64", "null", "array", "(4, 3)", "grid"),
    ]
    return f"with {EVENTS}, whole as (select * from t join hist using (dataset) join grid using (dataset)) " + " union all ".join(rows)


SQL |= {
    "cross_file_join_named": f"""with {PANEL_X},
      o as (select o_orderkey as obs_idx, o_orderpriority as priority from orders),
      n as (select priority, count(*) as n from o group by 1),
      s as (select priority, {', '.join(f"coalesce(sum(value) filter (var_idx = {i}), 0) as s{i}" for _, i in _NAMED)}
        from o left join x using (obs_idx) group by 1)
      select f as _file_name, priority, {', '.join(_r(f's{i} / n', f'"mean_{g}"') for g, i in _NAMED)}
      from n join s using (priority), unnest(['big', 'small']) as u(f)""",
    "scan_uns_multi": _uns_multi(),
    "validate_invalid": """select unnest(['obs', 'var']) as component, null::bigint as n_rows, false as valid,
      'dataset ''cells'' is not valid: it has neither obs nor var' as message""",
    "detect_roles_named": "select p_partkey as var_idx, p_brand as name, p_name as id from part",
    "dup_var_names_literal": """with recursive p as (select p_partkey as var_idx, p_brand as brand,
        case when p_partkey % 3 = 0 then p_brand || '_' || (p_partkey % 23 + 1) else p_brand end as name,
        row_number() over (partition by p_brand order by p_partkey) as i from part),
      w as (select brand, 0::bigint as i, []::varchar[] as used, null::bigint as var_idx, null::varchar as unique_name
          from (select distinct brand from p)
        union all select brand, i, list_append(used, u), var_idx, u from
          (select p.brand, p.i, p.var_idx, w.used, case when not list_contains(w.used, p.name) then p.name else p.name || '_' ||
             list_filter(range(1, p.i + 1), lambda k: not list_contains(w.used, p.name || '_' || k))[1] end as u
           from w join p on p.brand = w.brand and p.i = w.i + 1))
      select var_idx, unique_name from w where i > 0""",
    "stored_genes": f"with {OBS}, {X} " + _wide("obs", "x", "value", [(7, "G000007"), (100, "G000100"), (150, "G000150")], "double"),
}
