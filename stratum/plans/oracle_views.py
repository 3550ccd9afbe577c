"""The fixture views of :mod:`stratum.plans.tables` as plain SQL (DuckDB dialect).

Used only by the independent SQL oracle: each oracle query is
``WITH <needed views> SELECT ...`` over the pre-registered base tables.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_line": ((), """
        SELECT CAST(year(o.o_orderdate) AS SMALLINT) AS yr,
               l.l_suppkey AS party_no, s.s_name AS party_name,
               l.l_returnflag AS seg, l.l_linestatus AS subseg,
               CAST(l.l_extendedprice AS DECIMAL(20,2)) AS amount,
               l.l_orderkey, l.l_linenumber, c.c_mktsegment, n.n_name, r.r_regionkey
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN supplier s ON l.l_suppkey = s.s_suppkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    "v_parent": (("v_line",), """
        SELECT yr, party_no, party_name, seg, count(*) AS qty,
               CAST(sum(amount) AS DECIMAL(38,2)) AS amount
        FROM v_line GROUP BY yr, party_no, party_name, seg"""),
    "v_child": (("v_line",), """
        SELECT yr, party_no, party_name, seg, subseg, count(*) AS qty,
               CAST(sum(amount) AS DECIMAL(38,2)) AS amount
        FROM v_line GROUP BY yr, party_no, party_name, seg, subseg"""),
    "v_child_bad": (("v_child",), """
        SELECT * FROM v_child WHERE NOT (party_no % 7 = 0 AND seg = 'A')
        UNION ALL
        SELECT yr, CAST(-1 AS BIGINT) AS party_no, party_name, seg, subseg, qty, amount
        FROM v_child WHERE party_no = 1"""),
    "v_geo": (("v_line",), """
        SELECT l_orderkey, l_linenumber, yr, party_no, seg, subseg, amount,
               CASE r_regionkey % 3 WHEN 0 THEN 'NATIONAL' WHEN 1 THEN 'STATE' ELSE 'CITY' END AS lvl,
               CASE WHEN r_regionkey % 3 <> 0 THEN n_name END AS uf,
               CASE WHEN r_regionkey % 3 = 2 THEN substr(c_mktsegment, 1, 3) END AS ue,
               CASE WHEN r_regionkey % 3 = 2 THEN c_mktsegment END AS city
        FROM v_line"""),
    "v_geo_bad": (("v_geo",), """
        SELECT l_orderkey, l_linenumber, yr, party_no, seg, subseg, amount,
               CASE WHEN l_orderkey % 37 = 0 THEN 'OTHER' ELSE lvl END AS lvl,
               CASE WHEN l_orderkey % 29 = 0 THEN '' ELSE uf END AS uf,
               ue,
               CASE WHEN l_orderkey % 31 = 0 THEN 'FILLED' ELSE city END AS city
        FROM v_geo"""),
    "v_raw": ((), """
        SELECT o_orderkey AS k,
               CAST(year(o_orderdate) AS INTEGER) AS part_yr,
               CAST(year(o_orderdate) AS VARCHAR) AS "YR",
               CASE WHEN o_orderkey % 13 = 0 THEN '-'
                    WHEN o_orderkey % 13 = 1 THEN '12x'
                    WHEN o_orderkey % 13 = 2 THEN '  ' || CAST(o_custkey AS VARCHAR) || ' '
                    WHEN o_orderkey % 13 = 3 THEN '+7'
                    ELSE CAST(o_custkey AS VARCHAR) END AS "INT_TXT",
               CASE WHEN o_orderkey % 17 = 0 THEN '#########'
                    WHEN o_orderkey % 17 = 1 THEN 'N/A'
                    WHEN o_orderkey % 17 = 2 THEN '1.2,3,4'
                    WHEN o_orderkey % 17 = 3 THEN '-5,25'
                    ELSE translate(format('{:,.2f}', o_totalprice), ',.', '.,') END AS "MONEY_TXT",
               CASE WHEN o_orderkey % 19 = 0 THEN '31/02/2024'
                    WHEN o_orderkey % 19 = 1 THEN ''
                    WHEN o_orderkey % 19 = 2 THEN '1/2/2024'
                    WHEN o_orderkey % 19 = 3 THEN '01/02/24'
                    ELSE strftime(o_orderdate, '%d/%m/%Y') END AS "DATE_TXT",
               CASE WHEN o_orderkey % 5 = 0 THEN '9:5'
                    WHEN o_orderkey % 5 = 1 THEN '13:21'
                    WHEN o_orderkey % 5 = 2 THEN '13:21:07'
                    WHEN o_orderkey % 5 = 3 THEN '25:00'
                    ELSE 'null' END AS "TIME_TXT",
               CASE WHEN o_orderkey % 3 = 0 THEN lower(o_orderstatus) ELSE o_orderstatus END AS "STATUS_TXT"
        FROM orders"""),
    "v_artifact": (("v_parent", "v_child"), """
        SELECT yr, dataset, CAST(observed AS BIGINT) AS observed,
               CAST(observed + CASE WHEN yr = 1997 THEN 1 ELSE 0 END AS BIGINT) AS expected
        FROM (SELECT yr, 'parent' AS dataset, count(*) AS observed FROM v_parent GROUP BY yr
              UNION ALL
              SELECT yr, 'parent' AS dataset, count(*) AS observed FROM v_parent WHERE yr = 2000 GROUP BY yr
              UNION ALL
              SELECT yr, 'child' AS dataset, count(*) AS observed FROM v_child WHERE yr <> 2001 GROUP BY yr)"""),
}


def with_views(body: str, *names: str) -> str:
    """``WITH`` clause holding ``names`` and everything they depend on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dep in VIEWS[name][0]:
            visit(dep)
        ordered.append(name)

    for n in names:
        visit(n)
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in ordered)
    return f"WITH {ctes}\n{body}"
