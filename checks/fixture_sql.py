"""DuckDB form of the test fixtures (``transactions``, ``transactions_dirty``, batches).

These CTE bodies are the test-input definitions; the engine never runs them.
"""

# The raw-record view over the driver tables.
TRANSACTIONS = """
SELECT row_number() OVER (ORDER BY o_orderdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
         l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax, l_returnflag, l_linestatus) - 1 AS row_id,
  strftime(o_orderdate, '%Y/%m/%d %H:%M') AS "Timestamp",
  lpad(CAST(o_custkey % 10 AS VARCHAR), 3, '0') AS "From Bank",
  concat('8', lpad(hex(o_custkey), 8, '0')) AS "Account",
  lpad(CAST(l_suppkey % 10 AS VARCHAR), 3, '0') AS "To Bank",
  concat('8', lpad(hex(l_suppkey), 8, '0')) AS "Account.1",
  CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))
       AS DECIMAL(18,4)) AS VARCHAR) AS "Amount Received",
  CASE s_nationkey % 5 WHEN 0 THEN 'US Dollar' WHEN 1 THEN 'Euro' WHEN 2 THEN 'Yuan' WHEN 3 THEN 'Yen'
       ELSE 'Bitcoin' END AS "Receiving Currency",
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS "Amount Paid",
  CASE c_nationkey % 5 WHEN 0 THEN 'US Dollar' WHEN 1 THEN 'Euro' WHEN 2 THEN 'Yuan' WHEN 3 THEN 'Yen'
       ELSE 'Bitcoin' END AS "Payment Currency",
  o_orderpriority AS "Payment Format",
  CASE WHEN l_returnflag = 'R' AND l_discount >= 0.1 THEN '1' ELSE '0' END AS "Is Laundering"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
"""

DIRTY = """
SELECT row_id,
  CASE WHEN row_id % 83 = 0 THEN 'bad:' || "Timestamp" ELSE "Timestamp" END AS "Timestamp",
  "From Bank", "Account", "To Bank", "Account.1",
  CASE WHEN row_id % 89 = 0 THEN '-' || "Amount Received" ELSE "Amount Received" END AS "Amount Received",
  "Receiving Currency",
  CASE WHEN row_id % 97 = 0 THEN NULL ELSE "Amount Paid" END AS "Amount Paid",
  "Payment Currency", "Payment Format", "Is Laundering"
FROM transactions
"""

# Training batch: row_id < ceil(0.2 * n).
CUT = "(SELECT (count(*) * 2 + 9) // 10 FROM transactions)"


def with_ctes(body: str, *ctes: tuple[str, str], dirty: bool = False) -> str:
    parts = [("transactions", TRANSACTIONS)]
    if dirty:
        parts.append(("transactions_dirty", DIRTY))
    parts.extend(ctes)
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in parts) + "\n" + body
