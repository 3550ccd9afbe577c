"""Independent SQL (DuckDB dialect) for each registered query.

Written from the query's meaning, not from the Spark plan; views come from
:mod:`stratum.plans.oracle_views`.  Every computed column has the same alias
as on the Spark side.
"""

from __future__ import annotations

from stratum.plans.oracle_views import with_views as W

KIND = "CASE WHEN yr % 2 = 0 THEN 'even' ELSE 'odd' END"

ORACLE: dict[str, str] = {}

# --------------------------------------------------------------- batch 1: marts

ORACLE["total_by_year_party_gender"] = W(
    """SELECT yr, party_name, seg, CAST(sum(amount) AS DECIMAL(38,2)) AS total_amount
    FROM v_line GROUP BY yr, party_name, seg""",
    "v_line",
)
ORACLE["total_one_year"] = W(
    """SELECT yr, CAST(sum(amount) AS DECIMAL(38,2)) AS total
    FROM v_parent WHERE yr = 1998 GROUP BY yr""",
    "v_parent",
)
ORACLE["rows_per_partition"] = W(
    "SELECT yr, count(*) AS rows FROM v_parent GROUP BY yr",
    "v_parent",
)
ORACLE["view_parent"] = W(
    f"""SELECT yr, {KIND} AS kind, party_no, party_name, seg,
        count(*) AS qty, CAST(sum(amount) AS DECIMAL(38,2)) AS amount
    FROM v_line GROUP BY yr, party_no, party_name, seg""",
    "v_line",
)
ORACLE["view_child"] = W(
    f"""SELECT yr, {KIND} AS kind, party_no, party_name, seg, subseg,
        count(*) AS qty, CAST(sum(amount) AS DECIMAL(38,2)) AS amount
    FROM v_line GROUP BY yr, party_no, party_name, seg, subseg""",
    "v_line",
)
ORACLE["view_location"] = W(
    f"""SELECT g.yr, {KIND.replace('yr', 'g.yr')} AS kind, g.party_no, p.party_name,
        g.lvl, g.uf, g.ue, g.city, g.seg,
        count(*) AS qty, CAST(sum(g.amount) AS DECIMAL(38,2)) AS amount
    FROM v_geo g JOIN (SELECT DISTINCT yr, party_no, party_name FROM v_line) p
      ON p.yr = g.yr AND p.party_no = g.party_no
    GROUP BY g.yr, g.party_no, p.party_name, g.lvl, g.uf, g.ue, g.city, g.seg""",
    "v_geo", "v_line",
)
ORACLE["view_location_child"] = W(
    f"""SELECT g.yr, {KIND.replace('yr', 'g.yr')} AS kind, g.party_no, p.party_name,
        g.lvl, g.uf, g.ue, g.city, g.seg, g.subseg,
        count(*) AS qty, CAST(sum(g.amount) AS DECIMAL(38,2)) AS amount
    FROM v_geo g JOIN (SELECT DISTINCT yr, party_no, party_name FROM v_line) p
      ON p.yr = g.yr AND p.party_no = g.party_no
    GROUP BY g.yr, g.party_no, p.party_name, g.lvl, g.uf, g.ue, g.city, g.seg, g.subseg""",
    "v_geo", "v_line",
)
ORACLE["parameterised_sql"] = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice
    FROM orders WHERE year(o_orderdate) = 1998 AND o_orderstatus = 'F'"""


# ------------------------------------------------------------ batch 2: cleaning

WS = (r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+")
TOKENS = "'', '-', 'na', 'n/a', 'null', 'none', 'nan'"
SENTINELS = "'#########', '#div/0!', '#n/a', '#valor!'"


def CLEAN(x: str) -> str:
    collapsed = f"trim(regexp_replace({x}, '{WS}', ' ', 'g'))"
    return f"(CASE WHEN lower({collapsed}) IN ({TOKENS}) THEN NULL ELSE {collapsed} END)"


def INT(c: str, t: str = "INTEGER") -> str:
    return f"(CASE WHEN regexp_full_match({c}, '-?[0-9]+') THEN TRY_CAST({c} AS {t}) END)"


def DEC(c: str) -> str:
    n = f"replace(replace({c}, '.', ''), ',', '.')"
    return (f"(CASE WHEN regexp_full_match({n}, '-?[0-9]+(\\.[0-9]{{1,10}})?') "
            f"AND lower({c}) NOT IN ({SENTINELS}) THEN TRY_CAST({n} AS DECIMAL(38,10)) END)")


DATE_RE = "(0?[1-9]|[12][0-9]|3[01])/(0?[1-9]|1[0-2])/[0-9]{4}"
TIME_RE = "^([01]?[0-9]|2[0-3]):([0-5]?[0-9])(:([0-5]?[0-9]))?$"


def DATE(c: str) -> str:
    return (f"(CASE WHEN regexp_full_match({c}, '{DATE_RE}') "
            f"THEN CAST(try_strptime({c}, '%d/%m/%Y') AS DATE) END)")


def TIME(c: str) -> str:
    def part(i: int) -> str:
        return f"lpad(regexp_extract({c}, '{TIME_RE}', {i}), 2, '0')"

    sec = f"(CASE WHEN regexp_extract({c}, '{TIME_RE}', 4) = '' THEN '00' ELSE {part(4)} END)"
    return (f"(CASE WHEN regexp_matches({c}, '{TIME_RE}') "
            f"THEN {part(1)} || ':' || {part(2)} || ':' || {sec} END)")


def TS(d: str, t: str) -> str:
    return f"(CASE WHEN {d} IS NOT NULL AND {t} IS NOT NULL THEN CAST(CAST({d} AS VARCHAR) || 'T' || {t} AS TIMESTAMP) END)"


RAW_COLS = ("YR", "INT_TXT", "MONEY_TXT", "DATE_TXT", "TIME_TXT", "STATUS_TXT")
# raw_c: cleaned raw cells; raw_b: the same with every cell blank where k % 41 = 0
RAW_CLEAN = ("SELECT k, part_yr, "
             + ", ".join(f"{CLEAN(c)} AS {c.lower()}" for c in RAW_COLS) + " FROM v_raw")
RAW_BLANK_CLEAN = (
    "SELECT k, part_yr, "
    + ", ".join(f"CASE WHEN k % 41 = 0 THEN NULL ELSE {CLEAN(c)} END AS {c.lower()}" for c in RAW_COLS)
    + " FROM v_raw")
NOT_BLANK = "coalesce(yr, int_txt, money_txt, date_txt, time_txt, status_txt) IS NOT NULL"
KIND_P = "CASE WHEN part_yr % 2 = 0 THEN 'even' ELSE 'odd' END"


def RAW(body: str, blanks: bool = False) -> str:
    src = RAW_BLANK_CLEAN if blanks else RAW_CLEAN
    return W(f"WITH_RAW_C AS ({src})\n{body}", "v_raw").replace("WITH_RAW_C", ", raw_c")


def _typed_sql(where_blank: bool) -> str:
    return f"""SELECT k, part_yr, {INT('yr')} AS yr, {INT('int_txt')} AS int_val,
        {DEC('money_txt')} AS money_val, {DATE('date_txt')} AS date_val,
        {TIME('time_txt')} AS time_val, upper(status_txt) AS status,
        yr AS yr_c, int_txt, money_txt, date_txt, time_txt
      FROM raw_c {'WHERE ' + NOT_BLANK if where_blank else ''}"""


ORACLE["clean_tokens"] = W(
    "SELECT k, col AS \"column\", " + CLEAN("raw") + " AS cleaned, upper(" + CLEAN("raw") + ") AS category, "
    + CLEAN("raw") + " IS NULL AS is_null "
    "FROM (UNPIVOT (SELECT k, " + ", ".join(f'"{c}"' for c in RAW_COLS) + " FROM v_raw) "
    "ON " + ", ".join(f'"{c}"' for c in RAW_COLS) + " INTO NAME col VALUE raw)",
    "v_raw",
)
ORACLE["clean_documents"] = (
    f"SELECT doc_id, CAST(length({CLEAN('text')}) AS BIGINT) AS clean_len, "
    f"{CLEAN('text')} IS NULL AS is_null FROM documents"
)
ORACLE["parse_integer"] = RAW(
    f"SELECT k, {INT('int_txt')} AS value, int_txt IS NOT NULL AND {INT('int_txt')} IS NULL AS invalid FROM raw_c")
ORACLE["parse_decimal"] = RAW(
    f"SELECT k, {DEC('money_txt')} AS value, money_txt IS NOT NULL AND {DEC('money_txt')} IS NULL AS invalid FROM raw_c")
ORACLE["parse_date"] = RAW(
    f"SELECT k, {DATE('date_txt')} AS value, date_txt IS NOT NULL AND {DATE('date_txt')} IS NULL AS invalid FROM raw_c")
ORACLE["parse_time"] = RAW(
    f"SELECT k, {TIME('time_txt')} AS value, time_txt IS NOT NULL AND {TIME('time_txt')} IS NULL AS invalid FROM raw_c")
ORACLE["parse_timestamp"] = RAW(
    f"SELECT k, date_val, time_val, {TS('date_val', 'time_val')} AS ts_val FROM "
    f"(SELECT k, {DATE('date_txt')} AS date_val, {TIME('time_txt')} AS time_val FROM raw_c)")
ORACLE["normalize_table"] = (
    f"SELECT p_partkey AS codigo_peca, {CLEAN('p_name')} AS nome_completo, {CLEAN('p_brand')} AS marca, "
    f"p_size AS tamanho_cm, p_retailprice AS preco_varejo, CAST(NULL AS VARCHAR) AS campo_vazio, "
    f"{CLEAN('upper(p_type)')} AS tipo_produto FROM part"
)
ORACLE["blank_record_filter"] = RAW(f"SELECT k FROM raw_c WHERE {NOT_BLANK}", blanks=True)
ORACLE["silver_typed"] = RAW(
    f"""SELECT 'silver' AS silver_layer, 'fixture' AS source_name, k AS source_row_number,
        'orders.parquet' AS source_archive, 'raw_orders_' || part_yr || '.csv' AS source_member,
        yr, {KIND_P} AS tipo_eleicao, 'raw' AS tipo_fundo, 'orders' AS dimensao_agregacao,
        int_val, money_val, date_val, time_val, status, {TS('date_val', 'time_val')} AS ts_val
    FROM ({_typed_sql(True)})""")
ORACLE["invalid_counts"] = RAW(
    f"""SELECT source_member, "column", n FROM (
      SELECT 'raw_orders_' || part_yr || '.csv' AS source_member,
        count(*) FILTER (WHERE yr_c IS NOT NULL AND yr IS NULL) AS yr,
        count(*) FILTER (WHERE int_txt IS NOT NULL AND int_val IS NULL) AS int_val,
        count(*) FILTER (WHERE money_txt IS NOT NULL AND money_val IS NULL) AS money_val,
        count(*) FILTER (WHERE date_txt IS NOT NULL AND date_val IS NULL) AS date_val,
        count(*) FILTER (WHERE time_txt IS NOT NULL AND time_val IS NULL) AS time_val
      FROM ({_typed_sql(True)}) GROUP BY part_yr
    ) UNPIVOT (n FOR "column" IN (yr, int_val, money_val, date_val, time_val)) WHERE n > 0""")
ORACLE["silver_totals"] = RAW(
    f"""SELECT part_yr AS yr, CAST(count(*) AS BIGINT) AS source_rows,
        CAST(count(*) FILTER (WHERE {NOT_BLANK}) AS BIGINT) AS rows
    FROM raw_c GROUP BY ROLLUP (part_yr)""", blanks=True)
ORACLE["partition_year_check"] = RAW(
    f"""SELECT k, part_yr, date_val FROM ({_typed_sql(True)})
    WHERE year(date_val) IS DISTINCT FROM part_yr""")
_MEMBER_NAME = ("'dir/' || CASE o_orderkey % 4 WHEN 0 THEN 'fefc_genero' WHEN 1 THEN 'fefc_cor_raca' "
                "WHEN 2 THEN 'fp_genero' ELSE 'fp_cor_raca' END || '_' || "
                "CAST(CASE WHEN o_orderkey % 11 = 2 THEN 1900 ELSE year(o_orderdate) END AS VARCHAR) || '.csv'")
_MEMBER_RE = "^(fefc|fp)_(genero|cor_raca)_([0-9]{4})\\.csv$"
ORACLE["member_classification"] = f"""
WITH m AS (
  SELECT o_orderkey AS k, year(o_orderdate) AS part_yr,
    CASE WHEN o_orderkey % 11 = 0 THEN upper({_MEMBER_NAME})
         WHEN o_orderkey % 11 = 1 THEN translate({_MEMBER_NAME}, '_', '-')
         ELSE {_MEMBER_NAME} END AS name
  FROM orders),
b AS (SELECT *, regexp_extract(name, '([^/]+)$', 1) AS base FROM m),
c AS (SELECT *, regexp_matches(base, '{_MEMBER_RE}', 'i') AS ok FROM b)
SELECT k, name,
  CASE WHEN ok THEN lower(regexp_extract(base, '{_MEMBER_RE}', 1, 'i')) || '_' || lower(regexp_extract(base, '{_MEMBER_RE}', 2, 'i')) END AS dataset,
  CASE WHEN ok THEN lower(regexp_extract(base, '{_MEMBER_RE}', 1, 'i')) END AS fund,
  CASE WHEN ok THEN lower(regexp_extract(base, '{_MEMBER_RE}', 2, 'i')) END AS dimension,
  CASE WHEN ok THEN CAST(regexp_extract(base, '{_MEMBER_RE}', 3, 'i') AS INTEGER) END AS member_year,
  CASE WHEN NOT ok THEN 'unrecognised'
       WHEN CAST(regexp_extract(base, '{_MEMBER_RE}', 3, 'i') AS INTEGER) <> part_yr THEN 'year_mismatch'
       ELSE 'ok' END AS status
FROM c"""


# ----------------------------------------------------------- batch 3: row rules

BLANK_RE = WS[:-1] + "*"


def BLANK(x: str) -> str:
    return f"({x} IS NULL OR regexp_full_match({x}, '{BLANK_RE}'))"


def TINT(x: str) -> str:
    return f"TRY_CAST(trim({x}) AS BIGINT)"


def TDEC(x: str) -> str:
    return f"TRY_CAST(trim({x}) AS DECIMAL(38,10))"


# q: the fixture silver read back as text (what the quality step sees)
Q_SQL = f"""SELECT 'raw_orders_' || part_yr || '.csv' AS source_member,
    CAST(k AS VARCHAR) AS source_row_number, 'silver' AS silver_layer, 'fixture' AS source_name,
    {KIND_P} AS tipo_eleicao, 'raw' AS tipo_fundo, 'orders' AS dimensao_agregacao,
    CAST(yr AS VARCHAR) AS yr, CAST(int_val AS VARCHAR) AS int_val, CAST(money_val AS VARCHAR) AS money_val,
    CAST(date_val AS VARCHAR) AS date_val, time_val, status,
    strftime({TS('date_val', 'time_val')}, '%Y-%m-%dT%H:%M:%S') AS ts_val,
    int_raw, money_raw, pct_val, k AS rec, part_yr
  FROM ({_typed_sql(True).replace('FROM raw_c', ', int_raw, money_raw, pct_val FROM raw_c')})"""
RAW_CLEAN_Q = RAW_CLEAN.replace(
    " FROM v_raw",
    ", \"INT_TXT\" AS int_raw, replace(replace(\"MONEY_TXT\", '.', ''), ',', '.') AS money_raw, "
    "CAST((k % 120) - 5 AS VARCHAR) AS pct_val FROM v_raw")


def QV(body: str) -> str:
    return W(f"WITH_RAW_C AS ({RAW_CLEAN_Q}), q AS ({Q_SQL})\n{body}", "v_raw").replace("WITH_RAW_C", ", raw_c")


def _rule(rule: str, sev: str, col: str, pred: str, msg: str) -> str:
    return (f"SELECT source_member AS artifact, {TINT('source_row_number')} AS record_no, '{rule}' AS rule, "
            f"'{sev}' AS severity, '{col}' AS \"column\", '{msg}' AS message FROM q WHERE {pred}")


def _null_rule(rule: str, sev: str, pred: str, msg: str) -> str:
    return (f"SELECT source_member AS artifact, {TINT('source_row_number')} AS record_no, '{rule}' AS rule, "
            f"'{sev}' AS severity, CAST(NULL AS VARCHAR) AS \"column\", '{msg}' AS message FROM q WHERE {pred}")


RULES: dict[str, list[str]] = {
    "required_not_null": [
        _rule("required_not_null", "error", c, BLANK(c), f"required field {c} is null")
        for c in ("date_val", "int_val", "status", "time_val", "ts_val", "yr")
    ],
    "source_numeric_null": [
        _rule("source_numeric_null", "warning", "money_val", BLANK("money_val"),
              "money_val is null after an invalid source value")
    ],
    "invalid_integer": [
        _rule("invalid_integer", "error", c, f"NOT {BLANK(c)} AND {TINT(c)} IS NULL",
              f"field {c} is not a valid integer")
        for c in ("int_raw", "int_val", "source_row_number", "yr")
    ],
    "negative_value": [
        _rule("negative_value", "error", c, f"NOT {BLANK(c)} AND {TINT(c)} < 0", f"field {c} cannot be negative")
        for c in ("int_raw", "int_val")
    ],
    "invalid_decimal": [
        _rule("invalid_decimal", "error", c, f"NOT {BLANK(c)} AND {TDEC(c)} IS NULL",
              f"field {c} is not a valid decimal")
        for c in ("money_raw", "money_val", "pct_val")
    ],
    "percentage_outlier": [
        _rule("percentage_outlier", "warning", "pct_val", f"{TDEC('pct_val')} < 0 OR {TDEC('pct_val')} > 100",
              "field pct_val is outside 0..100")
    ],
    "negative_financial_value": [
        _rule("negative_financial_value", "warning", c, f"{TDEC(c)} < 0", f"amount {c} is negative")
        for c in ("money_raw", "money_val")
    ],
    "metadata_integrity": [
        _rule("metadata_integrity", "error", c, f"{c} IS DISTINCT FROM {v}", f"field {c} differs from its expected value")
        for c, v in (("silver_layer", "'silver'"), ("source_name", "'fixture'"), ("tipo_fundo", "'raw'"),
                     ("dimensao_agregacao", "'orders'"),
                     ("tipo_eleicao", "CASE WHEN TRY_CAST(yr AS INTEGER) % 2 = 0 THEN 'even' ELSE 'odd' END"))
    ],
    "accepted_values": [
        _rule("accepted_values", "error", "status", "NOT coalesce(status IN ('F', 'O'), false)",
              "status outside the accepted domain")
    ],
    "datetime_integrity": [
        _rule("datetime_integrity", "error", "ts_val",
              "NOT coalesce(regexp_full_match(ts_val, '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}') "
              "AND strftime(TRY_CAST(ts_val AS TIMESTAMP), '%Y-%m-%d') = date_val "
              "AND strftime(TRY_CAST(ts_val AS TIMESTAMP), '%H:%M:%S') = time_val, false)",
              "generation date-time invalid or inconsistent")
    ],
}


def _rules_query(*names: str) -> str:
    parts = [p for n in names for p in RULES[n]]
    body = " UNION ALL ".join(parts)
    return QV(f"SELECT artifact, record_no, rule, severity, \"column\" FROM ({body})")


ORACLE["quality_required"] = _rules_query("required_not_null", "source_numeric_null")
ORACLE["quality_accepted_values"] = _rules_query("accepted_values", "metadata_integrity")
ORACLE["quality_ranges"] = _rules_query("negative_value", "percentage_outlier", "negative_financial_value")
ORACLE["quality_numeric_validity"] = _rules_query("invalid_integer", "invalid_decimal")
ORACLE["quality_datetime"] = _rules_query("datetime_integrity")

_GEO = []
for lvl, req, forb in (("CITY", ("uf", "ue", "city"), ()), ("STATE", ("uf",), ("ue", "city")),
                       ("NATIONAL", (), ("uf", "ue", "city"))):
    for c in req:
        _GEO.append(f"SELECT l_orderkey, '{c}' AS \"column\", '{c} required for level {lvl}' AS message "
                    f"FROM v_geo_bad WHERE lvl = '{lvl}' AND {BLANK(c)}")
    for c in forb:
        _GEO.append(f"SELECT l_orderkey, '{c}' AS \"column\", '{c} must be null for level {lvl}' AS message "
                    f"FROM v_geo_bad WHERE lvl = '{lvl}' AND NOT {BLANK(c)}")
ORACLE["quality_conditional_required"] = W(" UNION ALL ".join(_GEO), "v_geo_bad")
ORACLE["null_counts"] = W(
    " UNION ALL ".join(
        f"SELECT yr, '{c}' AS \"column\", count(*) AS n FROM v_geo_bad WHERE {BLANK(c)} GROUP BY yr"
        for c in ("lvl", "uf", "ue", "city")
    ),
    "v_geo_bad",
)
ORACLE["positive_fields"] = """SELECT c_custkey, 'c_acctbal' AS field, CAST(c_acctbal AS VARCHAR) AS value,
      'c_acctbal must be a number above zero, not ' || coalesce(CAST(c_acctbal AS VARCHAR), 'null') AS message
    FROM customer WHERE NOT coalesce(c_acctbal > 0, false)"""

# ----------------------------------------------------------- batch 4: set rules

_LI_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
            "l_tax, l_returnflag, l_linestatus, l_shipdate")
ORACLE["duplicate_grain"] = f"""SELECT {_LI_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LI_COLS}) AS rn
    FROM lineitem) WHERE rn > 1"""
ORACLE["duplicate_tied"] = f"""SELECT {_LI_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_linenumber, {_LI_COLS}) AS rn
    FROM lineitem) WHERE rn > 1"""
ORACLE["frequent_keys"] = """SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY ALL HAVING count(*) >= (SELECT count(*) FROM lineitem) * 0.02"""
ORACLE["duplicate_source_row"] = """SELECT event_id, day, user_id FROM (
    SELECT event_id, CAST(ts AS DATE) AS day, user_id,
      row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY ts, event_id) AS rn
    FROM events) WHERE rn > 1"""
ORACLE["duplicate_rows"] = """SELECT event_id, ts, user_id, event_type, value, props FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id) AS rn
    FROM events) WHERE rn > 1"""
ORACLE["coverage_check"] = W(
    """, p AS (SELECT DISTINCT yr, party_no, party_name, seg FROM v_parent),
    c AS (SELECT DISTINCT yr, party_no, party_name, seg FROM v_child_bad),
    parents AS (SELECT yr, count(*) AS parents FROM p GROUP BY yr),
    sides AS (
      SELECT yr, 'parent_without_child' AS side, count(*) AS n FROM (SELECT * FROM p EXCEPT SELECT * FROM c) GROUP BY yr
      UNION ALL
      SELECT yr, 'child_without_parent' AS side, count(*) AS n FROM (SELECT * FROM c EXCEPT SELECT * FROM p) GROUP BY yr)
    SELECT s.yr, side, n, round(n / greatest(coalesce(parents, 0), 1)::DOUBLE, 6) AS rate
    FROM sides s LEFT JOIN parents USING (yr)""",
    "v_parent", "v_child_bad",
).replace("\n, p AS", ", p AS", 1)
ORACLE["dataset_completeness"] = W(
    """, a AS (SELECT yr, dataset, count(*) AS c FROM v_artifact GROUP BY yr, dataset)
    SELECT yr,
      concat_ws(',', CASE WHEN count(*) FILTER (WHERE dataset = 'child') = 0 THEN 'child' END,
                     CASE WHEN count(*) FILTER (WHERE dataset = 'parent') = 0 THEN 'parent' END) AS missing,
      coalesce(string_agg(dataset, ',' ORDER BY dataset) FILTER (WHERE c > 1), '') AS duplicated,
      coalesce(string_agg(dataset, ',' ORDER BY dataset) FILTER (WHERE dataset NOT IN ('child', 'parent')), '') AS extra,
      CAST((CASE WHEN count(*) FILTER (WHERE dataset = 'child') = 0 THEN 1 ELSE 0 END)
         + (CASE WHEN count(*) FILTER (WHERE dataset = 'parent') = 0 THEN 1 ELSE 0 END)
         + count(*) FILTER (WHERE c > 1) AS BIGINT) AS n_issues
    FROM a GROUP BY yr""",
    "v_artifact",
)
ORACLE["missing_columns"] = W(
    """SELECT DISTINCT 'child_' || CAST(yr AS VARCHAR) AS artifact, 'missing_column' AS rule,
        'source_member' AS "column" FROM v_child""",
    "v_child",
)
ORACLE["schema_integrity"] = """SELECT DISTINCT 'orders_' || CAST(year(o_orderdate) AS VARCHAR) || '.csv' AS artifact,
      'schema_integrity' AS rule, 'error' AS severity, 'stored schema differs from the silver manifest' AS message, CAST(1 AS BIGINT) AS n
    FROM orders WHERE year(o_orderdate) % 4 <> 2"""
ORACLE["scope_check"] = """SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS rows FROM orders
    GROUP BY year(o_orderdate) HAVING year(o_orderdate) NOT IN (1996, 1998, 2000)"""
ORACLE["duplicate_keys"] = """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
ORACLE["validate_table"] = """WITH s AS (
    SELECT count(*) AS record_count,
      count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicate_count,
      concat_ws(',',
        CASE WHEN count(*) FILTER (WHERE l_orderkey IS NULL) > 0 THEN 'l_orderkey' END,
        CASE WHEN count(*) FILTER (WHERE l_partkey IS NULL) > 0 THEN 'l_partkey' END,
        CASE WHEN count(*) FILTER (WHERE l_returnflag IS NULL OR l_returnflag = '') > 0 THEN 'l_returnflag' END,
        CASE WHEN count(*) FILTER (WHERE l_shipdate IS NULL) > 0 THEN 'l_shipdate' END) AS missing_fields
    FROM lineitem)
  SELECT (missing_fields = '' AND duplicate_count = 0) AS valid, CAST(record_count AS BIGINT) AS record_count,
    CAST(duplicate_count AS BIGINT) AS duplicate_count, missing_fields,
    concat_ws('; ',
      CASE WHEN missing_fields <> '' THEN 'required field ' ||
        replace(missing_fields, ',', ' is missing or empty; required field ') || ' is missing or empty' END,
      CASE WHEN duplicate_count > 0 THEN duplicate_count || ' rows repeat a key' END) AS messages,
    CAST((CASE WHEN missing_fields = '' THEN 0 ELSE length(missing_fields) - length(replace(missing_fields, ',', '')) + 1 END)
      + (CASE WHEN duplicate_count > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_messages
  FROM s"""

# ------------------------------------------------------------- batch 5: rollups

_ALL_RULES = " UNION ALL ".join(p for parts in RULES.values() for p in parts)
ISSUES_SQL = f""", row_issues AS ({_ALL_RULES}),
  arts AS (SELECT source_member AS artifact, CAST(part_yr AS INTEGER) AS yr, count(*) AS rows,
           count(*) + CASE WHEN part_yr = 1997 THEN 1 ELSE 0 END AS expected_rows
           FROM q GROUP BY source_member, part_yr),
  dup_grain AS (SELECT source_member AS artifact, rec AS record_no, 'duplicate_grain' AS rule, 'error' AS severity,
           CAST(NULL AS VARCHAR) AS "column", 'record duplicated in the grain' AS message FROM (
           SELECT *, row_number() OVER (PARTITION BY source_member, int_val, status ORDER BY rec) AS rn FROM q)
           WHERE rn > 1),
  dup_src AS (SELECT source_member AS artifact, rec AS record_no, 'duplicate_source_row' AS rule, 'error' AS severity,
           'source_row_number' AS "column", 'source row number repeated' AS message FROM (
           SELECT *, row_number() OVER (PARTITION BY source_member, source_row_number ORDER BY rec) AS rn FROM q)
           WHERE rn > 1),
  rc AS (SELECT artifact, CAST(NULL AS BIGINT) AS record_no, 'row_count_integrity' AS rule, 'error' AS severity,
           CAST(NULL AS VARCHAR) AS "column",
           'observed count ' || rows || ' differs from manifest ' || expected_rows AS message, 1 AS n
         FROM arts WHERE rows <> expected_rows),
  issues AS (
    SELECT *, 1 AS n FROM row_issues UNION ALL SELECT *, 1 AS n FROM dup_grain
    UNION ALL SELECT *, 1 AS n FROM dup_src UNION ALL SELECT * FROM rc)
"""


def IQ(body: str) -> str:
    """Query over the ``issues`` and ``arts`` tables of the fixture quality run."""
    sql = W(f"WITH_RAW_C AS ({RAW_CLEAN_Q}), q AS ({Q_SQL}){ISSUES_SQL}{body}", "v_raw")
    return sql.replace("WITH_RAW_C", ", raw_c")


ORACLE["issue_rollup"] = IQ("""SELECT g.artifact, rule, severity, "column", n,
      CASE WHEN coalesce(rows, 0) > 0 THEN round(n / rows::DOUBLE, 6) ELSE 1.0 END AS rate, message
    FROM (SELECT artifact, rule, severity, "column", CAST(sum(n) AS BIGINT) AS n,
            coalesce(arg_min(message, record_no), min(message)) AS message
          FROM issues GROUP BY artifact, rule, severity, "column") g
    LEFT JOIN arts a ON a.artifact = g.artifact""")
ORACLE["issue_samples"] = IQ("""SELECT artifact, rule, "column", position, record_no FROM (
      SELECT artifact, rule, "column", record_no,
        CAST(row_number() OVER (PARTITION BY artifact, rule, "column" ORDER BY record_no) AS BIGINT) AS position
      FROM issues WHERE record_no IS NOT NULL) WHERE position <= 5""")
ORACLE["artifact_profile"] = IQ("""SELECT a.artifact, a.yr, a.rows, a.expected_rows,
      CAST(coalesce(sum(CASE WHEN rule = 'duplicate_grain' THEN n ELSE 0 END), 0) AS BIGINT) AS duplicates,
      CAST(coalesce(sum(CASE WHEN severity = 'error' THEN n ELSE 0 END), 0) AS BIGINT) AS errors,
      CAST(coalesce(sum(CASE WHEN severity = 'warning' THEN n ELSE 0 END), 0) AS BIGINT) AS warnings
    FROM arts a LEFT JOIN issues i ON i.artifact = a.artifact
    GROUP BY a.artifact, a.yr, a.rows, a.expected_rows""")
ORACLE["quality_report_by_year"] = IQ("""SELECT a.yr, coalesce(e.errors, 0) = 0 AS valid,
      CAST(a.artifacts AS BIGINT) AS artifacts, CAST(a.rows AS BIGINT) AS rows,
      CAST(coalesce(e.errors, 0) AS BIGINT) AS errors, CAST(coalesce(e.warnings, 0) AS BIGINT) AS warnings
    FROM (SELECT yr, count(*) AS artifacts, sum(rows) AS rows FROM arts GROUP BY yr) a
    LEFT JOIN (SELECT CAST(regexp_extract(artifact, '_([0-9]{4})\\.csv$', 1) AS INTEGER) AS yr,
                 sum(CASE WHEN severity = 'error' THEN n ELSE 0 END) AS errors,
                 sum(CASE WHEN severity = 'warning' THEN n ELSE 0 END) AS warnings
               FROM issues GROUP BY 1) e ON e.yr = a.yr""")


# after the reload of 1997 its declared row count is right
_RELOADED = """kept AS (SELECT *, CAST(regexp_extract(artifact, '_([0-9]{4})\\.csv$', 1) AS INTEGER) AS yr FROM issues
      WHERE NOT (rule = 'row_count_integrity' AND regexp_extract(artifact, '_([0-9]{4})\\.csv$', 1) = '1997'))"""
ORACLE["incremental_report"] = IQ(f""", {_RELOADED} SELECT a.yr, coalesce(e.errors, 0) = 0 AS valid,
      CAST(a.artifacts AS BIGINT) AS artifacts, CAST(a.rows AS BIGINT) AS rows,
      CAST(coalesce(e.errors, 0) AS BIGINT) AS errors, CAST(coalesce(e.warnings, 0) AS BIGINT) AS warnings
    FROM (SELECT yr, count(*) AS artifacts, sum(rows) AS rows FROM arts GROUP BY yr) a
    LEFT JOIN (SELECT yr, sum(CASE WHEN severity = 'error' THEN n ELSE 0 END) AS errors,
                 sum(CASE WHEN severity = 'warning' THEN n ELSE 0 END) AS warnings FROM kept GROUP BY 1) e ON e.yr = a.yr""")
ORACLE["incremental_rollup"] = IQ(f""", {_RELOADED}, g AS (
      SELECT yr, artifact, rule, severity, "column", CAST(sum(n) AS BIGINT) AS n,
        coalesce(arg_min(message, record_no), min(message)) AS message,
        coalesce(array_to_string(list_slice(list(record_no ORDER BY record_no) FILTER (record_no IS NOT NULL), 1, 5), ','), '') AS records
      FROM kept GROUP BY ALL)
    SELECT g.yr, g.artifact, rule, severity, "column", n, CASE WHEN coalesce(rows, 0) > 0 THEN round(n / rows::DOUBLE, 6) ELSE 1.0 END AS rate,
      message, records FROM g LEFT JOIN arts ON arts.artifact = g.artifact AND arts.yr = g.yr""")


# ---------------------------------------------------------------- batch 6: gold

_PLACES = "(SELECT DISTINCT yr, lvl, uf, ue, city FROM v_geo)"
_SWAPPED = "SELECT {cols}, uf, ue FROM v_geo UNION ALL SELECT {cols}, ue AS uf, uf AS ue FROM v_geo"
ORACLE["dim_distinct"] = W("SELECT DISTINCT yr, party_no, party_name FROM v_line", "v_line")
ORACLE["dim_upsert"] = W(
    """, e AS (SELECT DISTINCT party_no, party_name FROM v_line WHERE yr <= 1998),
    n AS (SELECT DISTINCT party_no, lower(party_name) AS party_name FROM v_line WHERE yr >= 1998)
    SELECT party_no, party_name, party_no IN (SELECT party_no FROM e) AS id_kept FROM n
    UNION ALL SELECT party_no, party_name, true FROM e WHERE party_no NOT IN (SELECT party_no FROM n)""",
    "v_line",
)
ORACLE["dim_conflicts"] = W(
    """, named AS (SELECT DISTINCT yr, party_no,
            CASE WHEN party_no % 10 = 3 AND seg = 'A' THEN party_name || '*' ELSE party_name END AS party_name
          FROM v_parent),
    many AS (SELECT yr, party_no, count(*) AS n_values FROM named GROUP BY yr, party_no HAVING count(*) > 1)
    SELECT yr, party_no, party_name, n_values FROM named JOIN many USING (yr, party_no)""",
    "v_parent",
)
ORACLE["dim_insert_absent"] = W(
    "SELECT seg FROM (VALUES ('A'), ('N')) t(seg) UNION SELECT DISTINCT seg FROM v_line", "v_line")
ORACLE["dim_location"] = W(f"SELECT * FROM {_PLACES}", "v_geo")
ORACLE["location_key"] = W(
    f"""SELECT CAST(yr AS VARCHAR) || '|' || coalesce(lvl, '') || '|' || coalesce(trim(uf), '') || '|'
        || coalesce(ue, '') || '|' || coalesce(city, '') AS location_key FROM {_PLACES}""",
    "v_geo",
)
ORACLE["location_join"] = W(
    f""", g AS ({_SWAPPED.format(cols='yr, lvl, city, amount')}),
    places AS (SELECT *, row_number() OVER (ORDER BY yr, lvl, uf, ue, city) AS place_no
               FROM (SELECT DISTINCT yr, lvl, uf, ue, city FROM g))
    SELECT g.lvl, count(*) AS rows, CAST(sum(amount) AS DECIMAL(38,2)) AS total, count(DISTINCT place_no) AS places
    FROM g JOIN places p ON {' AND '.join(f'g.{c} IS NOT DISTINCT FROM p.{c}' for c in ('yr', 'lvl', 'uf', 'ue', 'city'))}
    GROUP BY g.lvl""",
    "v_geo",
)
ORACLE["surrogate_keys"] = W(
    f""", g AS (SELECT DISTINCT yr, lvl, uf, ue, city FROM ({_SWAPPED.format(cols='yr, lvl, city')})),
    ids AS (SELECT DISTINCT md5(concat_ws('|', yr, lvl, coalesce('=' || uf, 'null'), coalesce('=' || ue, 'null'),
                                          coalesce('=' || city, 'null'))) AS id FROM g)
    SELECT (SELECT count(*) FROM g) AS n_keys, (SELECT count(*) FROM ids) AS n_ids,
      (SELECT count(*) FROM g) = (SELECT count(*) FROM ids) AS collision_free""", "v_geo")
ORACLE["dim_last_writer"] = """SELECT user_id, arg_max(event_type, {'d': CAST(ts AS DATE), 'e': event_id}) AS event_type
    FROM events GROUP BY user_id"""
ORACLE["dense_keys"] = W("""SELECT yr, party_no, row_number() OVER (ORDER BY yr > 1998, yr, party_no) AS party_id
    FROM (SELECT DISTINCT yr, party_no FROM v_line)""", "v_line")
ORACLE["unique_check"] = W(
    """SELECT yr, l_orderkey, l_linenumber, count(*) AS n FROM v_geo
    GROUP BY yr, l_orderkey, l_linenumber HAVING count(*) > 1""",
    "v_geo",
)
ORACLE["constraint_check"] = W(
    """SELECT l_orderkey, l_linenumber, rule FROM (
      SELECT l_orderkey, l_linenumber, 'ck_level' AS rule,
        NOT coalesce(lvl IN ('NATIONAL', 'STATE', 'CITY'), true) AS bad FROM v_geo_bad
      UNION ALL
      SELECT l_orderkey, l_linenumber, 'ck_geography',
        NOT coalesce((lvl = 'NATIONAL' AND uf IS NULL AND ue IS NULL AND city IS NULL)
          OR (lvl = 'STATE' AND uf IS NOT NULL AND ue IS NULL AND city IS NULL)
          OR (lvl = 'CITY' AND uf IS NOT NULL AND ue IS NOT NULL AND city IS NOT NULL), true) FROM v_geo_bad
      UNION ALL
      SELECT l_orderkey, l_linenumber, 'ck_amount', NOT coalesce(amount >= 0, true) FROM v_geo_bad)
    WHERE bad""",
    "v_geo_bad",
)
ORACLE["foreign_key_check"] = """
    SELECT 'orders_customer' AS fk, count(*) AS violations FROM orders o
      WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
    UNION ALL
    SELECT 'lineitem_orders', count(*) FROM lineitem l
      WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
    UNION ALL
    SELECT 'labels_documents', count(*) FROM labels b
      WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = b.doc_id)"""
ORACLE["stage_count"] = W("SELECT count(*) AS staged FROM v_child_bad", "v_child_bad")
ORACLE["load_reconciliation"] = W(
    """, s AS (SELECT yr, party_no, party_name, seg, subseg, count(*) AS s_n FROM v_child_bad
              GROUP BY yr, party_no, party_name, seg, subseg),
    l AS (SELECT b.yr, b.party_no, b.party_name, b.seg, b.subseg, count(*) AS l_n
          FROM v_child_bad b JOIN (SELECT DISTINCT yr, party_no, party_name FROM v_line) p
            ON p.yr = b.yr AND p.party_no = b.party_no
          GROUP BY b.yr, b.party_no, b.party_name, b.seg, b.subseg)
    SELECT CAST(sum(s_n) AS BIGINT) AS staged,
      CAST(sum(least(s_n, coalesce(l_n, 0))) AS BIGINT) AS matched,
      CAST(sum(CASE WHEN l_n IS NULL THEN s_n ELSE 0 END) AS BIGINT) AS lost,
      CAST(sum(greatest(coalesce(l_n, 0) - s_n, 0)) AS BIGINT) AS fanned_out
    FROM s LEFT JOIN l ON s.yr IS NOT DISTINCT FROM l.yr AND s.party_no IS NOT DISTINCT FROM l.party_no
      AND s.party_name IS NOT DISTINCT FROM l.party_name AND s.seg IS NOT DISTINCT FROM l.seg
      AND s.subseg IS NOT DISTINCT FROM l.subseg""",
    "v_child_bad", "v_line",
)
ORACLE["fact_load"] = W(
    """SELECT yr, party_no, lvl, uf, ue, city, seg, subseg, count(*) AS qty,
        CAST(sum(amount) AS DECIMAL(38,2)) AS amount
    FROM v_geo GROUP BY yr, party_no, lvl, uf, ue, city, seg, subseg""",
    "v_geo",
)
ORACLE["slice_replace"] = W(
    """SELECT yr, count(*) AS rows, CAST(sum(amount) AS DECIMAL(38,2)) AS total FROM (
      SELECT yr, amount FROM v_parent WHERE yr <> 1998
      UNION ALL
      SELECT yr, CAST(amount * 2 AS DECIMAL(38,2)) FROM v_parent WHERE yr = 1998 AND seg = 'A')
    GROUP BY yr""",
    "v_parent",
)
_AUDIT = """, arts AS (SELECT yr, dataset, max(observed) AS n FROM v_artifact GROUP BY yr, dataset),
    audit AS (SELECT yr, dataset, n AS source_rows,
                CAST(CASE WHEN yr = 1998 THEN n ELSE 0 END AS BIGINT) AS deleted_rows, n AS inserted_rows
              FROM arts)
"""
ORACLE["audit_upsert"] = W(_AUDIT + "SELECT * FROM audit", "v_artifact")
ORACLE["audit_listing"] = W(_AUDIT + "SELECT * FROM audit ORDER BY yr, dataset", "v_artifact")
ORACLE["load_totals"] = W(
    _AUDIT + """SELECT count(*) AS artifacts, CAST(sum(n) AS BIGINT) AS staged, CAST(sum(n) AS BIGINT) AS deleted,
        CAST(sum(n) AS BIGINT) AS inserted FROM arts WHERE yr = 1998""",
    "v_artifact",
)
ORACLE["gated_backfill"] = W(
    """SELECT * FROM v_parent WHERE yr IN (SELECT yr FROM v_artifact) AND yr NOT IN (
      SELECT yr FROM v_artifact WHERE observed <> expected
      UNION
      SELECT yr FROM v_artifact GROUP BY yr
      HAVING count(*) FILTER (WHERE dataset = 'child') <> 1 OR count(*) FILTER (WHERE dataset = 'parent') <> 1)""",
    "v_parent", "v_artifact",
)
ORACLE["json_manifest"] = W(
    """SELECT yr, CAST(sum(observed) OVER (PARTITION BY yr) AS BIGINT) AS row_count, dataset, observed, expected
    FROM v_artifact""",
    "v_artifact",
)
ORACLE["issue_rollup_multi_year"] = W(
    """, p AS (SELECT DISTINCT yr, party_no, party_name, seg FROM v_parent),
    c AS (SELECT DISTINCT yr, party_no, party_name, seg FROM v_child_bad),
    n AS (SELECT yr, count(*) FILTER (WHERE side = 1) AS no_child, count(*) FILTER (WHERE side = 2) AS orphans
          FROM (SELECT *, 1 AS side FROM (SELECT * FROM p EXCEPT SELECT * FROM c)
                UNION ALL SELECT *, 2 AS side FROM (SELECT * FROM c EXCEPT SELECT * FROM p)) GROUP BY yr)
    SELECT n.yr, 'files' AS artifact, 'cross_dataset_integrity' AS rule, 'error' AS severity,
      CAST(NULL AS VARCHAR) AS "column", CAST(no_child + orphans AS BIGINT) AS n,
      round((no_child + orphans) / (SELECT count(*) FROM p WHERE p.yr = n.yr)::DOUBLE, 6) AS rate,
      'parent/child coverage inconsistent: without child=' || no_child || ', orphans=' || orphans AS message
    FROM n
    UNION ALL
    SELECT DISTINCT yr, dataset, 'row_count_integrity', 'error', CAST(NULL AS VARCHAR), CAST(1 AS BIGINT),
      round(1 / observed::DOUBLE, 6), 'observed count ' || observed || ' differs from manifest ' || expected
    FROM v_artifact WHERE observed <> expected""",
    "v_parent", "v_child_bad", "v_artifact",
)
ORACLE["silver_csv_round_trip"] = RAW(
    f"""SELECT CAST(k AS VARCHAR) AS source_row_number, CAST(yr AS VARCHAR) AS yr, CAST(int_val AS VARCHAR) AS int_val,
        CAST(date_val AS VARCHAR) AS date_val, time_val, status,
        ' ' || CAST(k AS VARCHAR) || ' "' || coalesce(time_val, 'null') || '"; \\"' || chr(10) || '\\' AS note
        FROM ({_typed_sql(True)})""")
_NOTED = """SELECT 'orders_' || CAST(year(o_orderdate) AS VARCHAR) AS stem, CAST(o_orderkey AS VARCHAR) AS key, o_orderstatus AS status,
      CASE o_orderkey % 3 WHEN 0 THEN 'said "' || o_orderpriority || '";' || chr(10) || 'then' || chr(13) || chr(10) || chr(92)
        || strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS note, o_orderkey FROM orders"""
ORACLE["member_files"] = f"SELECT stem || '_tratado.csv' AS file, key, status, note FROM ({_NOTED})"
ORACLE["member_records"] = f"""SELECT stem || '.csv' AS member, 'utf-8-sig' AS encoding,
      1 + row_number() OVER (PARTITION BY stem ORDER BY o_orderkey) AS record_no, key, status, coalesce(note, '') AS note, 3 AS width
    FROM ({_NOTED})"""
ORACLE["appended_table"] = W(
    """SELECT CAST(yr AS INTEGER) AS yr, count(*) AS rows, CAST(sum(amount) AS DECIMAL(38,2)) AS total
    FROM v_parent GROUP BY yr""",
    "v_parent",
)
