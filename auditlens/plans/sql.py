"""SQL building blocks of the oracle: the loan table and derived frames as CTEs."""

from __future__ import annotations


def draw(*parts: str, digits: int = 13) -> str:
    """Integer hash of the given SQL expressions."""
    text = "CAST(" + " AS VARCHAR)||'|'||CAST(".join(parts) + " AS VARCHAR)"
    return f"CAST('0x'||substr(md5({text}),1,{digits}) AS BIGINT)"


def unit(*parts: str) -> str:
    return f"(CAST({draw(*parts)} AS DOUBLE)/4503599627370496.0)"


def r(expr: str, digits: int = 6) -> str:
    return f"(round({expr},{digits})+CAST(0 AS DOUBLE))"


def margin(int_rate="int_rate", dti="dti", pct="pct_protected", inc="annual_inc", grade="grade") -> str:
    return (
        f"(-1.6::DOUBLE + 0.45::DOUBLE*({int_rate}-5.0::DOUBLE) + 0.06::DOUBLE*({dti}-25.0::DOUBLE)"
        f" + 0.25::DOUBLE*({pct}-4.0::DOUBLE) - 0.00008::DOUBLE*({inc}-4500.0::DOUBLE)"
        f" + CASE {grade} WHEN '1-URGENT' THEN -0.6::DOUBLE WHEN '5-LOW' THEN 0.8::DOUBLE ELSE 0.0::DOUBLE END"
        f" + 0.03::DOUBLE*({int_rate}-5.0::DOUBLE)*({dti}-25.0::DOUBLE))"
    )


def model(**cols) -> str:
    return f"(1.0::DOUBLE/(1.0::DOUBLE+exp(-{margin(**cols)})))"


def bucket(x: str, q: str) -> str:
    """Right-closed quartile number of x for the edge list q."""
    x = f"round({x},9)"
    e = [f"round({q}[{i}],9)" for i in range(1, 6)]
    return "(1" + "".join(
        f" + CASE WHEN {e[j]} > {e[j - 1]} AND {x} > {e[j]} THEN 1 ELSE 0 END" for j in range(1, 4)
    ) + ")"


def edges(x: str) -> str:
    return f"quantile_cont({x}, [0.0,0.25,0.5,0.75,1.0])"


LOANS = f"""
li AS (
  SELECT l_orderkey, SUM(CAST(ROUND(l_discount*100) AS BIGINT)) AS sd, SUM(CAST(ROUND(l_tax*100) AS BIGINT)) AS st,
         SUM(CAST(l_quantity AS BIGINT)) AS sq, COUNT(*) AS n_lines
  FROM lineitem GROUP BY l_orderkey),
base AS (
  SELECT o.o_orderkey AS loan_id, CAST(YEAR(o.o_orderdate) AS INTEGER) AS issue_d, o.o_totalprice AS funded_amnt,
         CAST(li.sd AS DOUBLE)/li.n_lines AS int_rate, CAST(li.sq AS DOUBLE)/li.n_lines AS dti,
         li.n_lines AS open_acc, c.c_acctbal AS annual_inc, CAST(li.st AS DOUBLE)/li.n_lines AS pct_protected,
         o.o_orderpriority AS grade, c.c_mktsegment AS home_ownership, n.n_name AS purpose
  FROM orders o JOIN customer c ON o.o_custkey=c.c_custkey JOIN nation n ON c.c_nationkey=n.n_nationkey
  LEFT JOIN li ON li.l_orderkey=o.o_orderkey),
z AS (SELECT *, {margin()} AS margin FROM base),
loans AS (
  SELECT *, ROUND(1.0/(1.0+EXP(-margin)),10) AS score,
    CASE WHEN CAST({draw('loan_id', digits=8)} AS DOUBLE)/4294967296.0 < 1.0/(1.0+EXP(-margin)) THEN 1 ELSE 0 END AS target
  FROM z),
ok AS (SELECT * FROM loans WHERE int_rate IS NOT NULL AND dti IS NOT NULL AND open_acc IS NOT NULL AND score IS NOT NULL),
sc AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS y_hat FROM ok),
pq AS (SELECT {edges('pct_protected')} AS q FROM ok),
aud AS (SELECT sc.*, CASE {bucket('pct_protected', '(SELECT q FROM pq)')}
    WHEN 1 THEN 'Q1_low' WHEN 2 THEN 'Q2' WHEN 3 THEN 'Q3' ELSE 'Q4_high' END AS "group" FROM sc)
"""


def on_loans(body: str) -> str:
    """Prefix a statement with the loan CTEs (``loans``, ``ok``, ``sc``, ``aud``)."""
    body = body.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {LOANS}, {body[4:]}"
    return f"WITH {LOANS} {body}"
