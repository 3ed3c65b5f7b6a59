"""DuckDB side of the oracle: the finance relations derived from the driver tables.

Only the driver tables are registered in DuckDB, so each oracle query inlines the
derivation (FIXTURES.md §1.2) as common table expressions. It mirrors
``statera.sources.derive`` column for column.
"""

from __future__ import annotations

import re

DERIVED_CTES = """
poz_suppliers_v AS (
  SELECT s_suppkey AS vendor_id, s_name AS vendor_name, CAST(s_suppkey AS VARCHAR) AS segment1,
         1000000000 + s_suppkey AS party_id FROM supplier),
poz_suppliers AS (SELECT vendor_id, segment1, party_id FROM poz_suppliers_v),
poz_supplier_sites_all_m AS (SELECT s_suppkey * 10 + 1 AS vendor_site_id, s_suppkey AS vendor_id FROM supplier),
hz_parties AS (
  SELECT 1000000000 + s_suppkey AS party_id, s_name AS party_name FROM supplier
  UNION ALL SELECT c_custkey AS party_id, c_name AS party_name FROM customer),
ap_lookup_codes AS (
  SELECT * FROM (VALUES ('INVOICE TYPE','STANDARD'), ('INVOICE TYPE','CREDIT'), ('INVOICE TYPE','PREPAYMENT'),
                        ('OTHER TYPE','UNLISTED')) AS t(lookup_type, lookup_code)),
ap_terms_val_v AS (SELECT * FROM (VALUES (0, 'IMMEDIATE'), (1, 'NET30')) AS t(term_id, name)),
ap_invoices_all AS (
  SELECT l_orderkey * 1000000 + l_suppkey AS invoice_id, l_suppkey AS vendor_id,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_suppkey * 10 + 1 END AS vendor_site_id,
         'INV-' || CAST(l_orderkey * 1000000 + l_suppkey AS VARCHAR) AS invoice_num,
         CASE l_orderkey % 5 WHEN 0 THEN 'CREDIT' WHEN 1 THEN 'PREPAYMENT' WHEN 2 THEN 'UNLISTED'
              ELSE 'STANDARD' END AS invoice_type_lookup_code,
         'PATIENT ' || CAST(o_custkey AS VARCHAR) AS description, CAST(o_orderdate AS DATE) AS invoice_date,
         'KES' AS invoice_currency_code,
         CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE CAST(1.25 AS DECIMAL(10,4)) END AS exchange_rate,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS invoice_amount,
         CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE l_orderkey % 3 END AS terms_id,
         CASE o_orderstatus WHEN 'O' THEN 'N' WHEN 'P' THEN 'P' ELSE 'Y' END AS payment_status_flag,
         CASE WHEN l_orderkey % 50 = 0 THEN CAST(o_orderdate AS DATE) END AS cancelled_date,
         CASE l_orderkey % 10 WHEN 0 THEN 'NEEDS REAPPROVAL' WHEN 1 THEN 'AVAILABLE' ELSE 'APPROVED' END
           AS approval_status,
         CASE l_orderkey % 7 WHEN 0 THEN 'REJECTED' WHEN 1 THEN 'NOT REQUIRED' WHEN 2 THEN 'MANUALLY APPROVED'
              ELSE 'WFAPPROVED' END AS wfapproval_status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY l_orderkey, l_suppkey, o_custkey, o_orderdate, o_orderstatus),
ap_payment_schedules_all AS (
  SELECT l_orderkey * 1000000 + l_suppkey AS invoice_id, CAST(o_orderdate AS DATE) + 30 AS due_date,
         CASE WHEN l_linestatus = 'F' THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END
           AS amount_remaining
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ap_trial_balances AS (
  SELECT l_orderkey * 1000000 + l_suppkey AS invoice_id, l_suppkey AS vendor_id,
         CASE WHEN l_orderkey % 11 = 0 THEN NULL
              ELSE SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)))
         END AS accounted_dr,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS accounted_cr
  FROM lineitem GROUP BY l_orderkey, l_suppkey),
ap_invoice_distributions_all AS (
  SELECT l_orderkey * 1000000 + l_suppkey AS invoice_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         CAST(l_shipdate AS DATE) AS accounting_date FROM lineitem),
ap_invoice_payments_all AS (
  SELECT l_orderkey * 1000000 + l_suppkey AS invoice_id, l_orderkey AS check_id,
         CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))
           AS amount,
         CASE WHEN l_discount = 0 THEN NULL
              ELSE CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) END AS discount_taken,
         CAST(l_shipdate AS DATE) + 15 AS accounting_date
  FROM lineitem WHERE l_returnflag <> 'N'),
ap_invoice_lines_all AS (
  SELECT l_orderkey * 1000000 + l_suppkey AS invoice_id,
         CASE l_linenumber % 3 WHEN 0 THEN 'TAX' WHEN 1 THEN 'AWT' ELSE 'ITEM' END AS line_type_lookup_code,
         CASE WHEN l_linenumber % 3 = 1 THEN -(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)))
              ELSE CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) END AS amount
  FROM lineitem),
ap_checks_all AS (
  SELECT o_orderkey AS check_id, o_orderkey AS payment_id, MIN(l_suppkey) AS vendor_id, 'KES' AS currency_code
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'O' GROUP BY o_orderkey),
iby_payments_all AS (
  SELECT o_orderkey AS payment_id, 500000 + o_orderkey AS payment_reference_number,
         CAST(o_orderdate AS DATE) + 20 AS payment_date, CAST(o_totalprice AS DECIMAL(18,2)) AS payment_amount,
         CASE o_orderkey % 13 WHEN 0 THEN 'VOID' WHEN 1 THEN 'VOID_BY_OVERFLOW' WHEN 2 THEN NULL ELSE 'ISSUED' END
           AS payment_status
  FROM orders WHERE o_orderstatus <> 'O'),
hz_cust_accounts AS (
  SELECT c_custkey AS cust_account_id, c_custkey AS party_id, 'AC' || CAST(c_custkey AS VARCHAR) AS account_number
  FROM customer),
ra_customer_trx_all AS (
  SELECT o_orderkey AS customer_trx_id, 'TRX' || CAST(o_orderkey AS VARCHAR) AS trx_number,
         CAST(o_orderdate AS DATE) AS trx_date, o_custkey AS bill_to_customer_id,
         CASE o_orderkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'KES' END AS invoice_currency_code,
         CASE o_orderkey % 5 WHEN 0 THEN 'OTHER' WHEN 1 THEN NULL ELSE 'PATIENT AND SPONSER DETAILS' END
           AS attribute_category,
         'P' || CAST(o_custkey % 20 AS VARCHAR) AS attribute1,
         'PATIENT ' || CAST(o_custkey % 20 AS VARCHAR) AS attribute2, o_orderpriority AS attribute12
  FROM orders),
ra_customer_trx_lines_all AS (
  SELECT ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS customer_trx_line_id,
         l_orderkey AS customer_trx_id, CASE WHEN l_linestatus = 'O' THEN 'LINE' ELSE 'TAX' END AS line_type,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS extended_amount
  FROM lineitem),
ra_cust_trx_line_gl_dist_all AS (
  SELECT ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS customer_trx_line_id,
         CAST(l_shipdate AS DATE) AS gl_date FROM lineitem
  UNION ALL
  SELECT ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS customer_trx_line_id,
         CAST(l_shipdate AS DATE) AS gl_date FROM lineitem WHERE l_linenumber = 7),
ar_cash_receipts_all AS (
  SELECT o_orderkey AS cash_receipt_id,
         CASE WHEN o_orderkey % 3 = 0 THEN 'DR' ELSE 'RC' END || CAST(o_orderkey AS VARCHAR) AS receipt_number,
         CAST(o_orderdate AS DATE) + 10 AS receipt_date,
         CASE o_orderkey % 6 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'KES' END AS currency_code,
         CASE WHEN o_orderkey % 29 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(o_totalprice AS DECIMAL(18,2)) END
           AS amount,
         CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_custkey END AS pay_from_customer,
         CASE WHEN o_orderkey % 17 = 0 THEN 'REV' WHEN o_orderkey % 19 = 0 THEN NULL ELSE 'APP' END AS status,
         'P' || CAST(o_custkey % 20 AS VARCHAR) AS attribute1
  FROM orders WHERE o_orderstatus <> 'O'),
ar_receivable_applications_all AS (
  SELECT l_orderkey AS cash_receipt_id, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_orderkey END
           AS applied_customer_trx_id,
         CASE WHEN l_returnflag = 'N' THEN 'UNAPP' ELSE 'APP' END AS status,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount_applied, CAST(l_shipdate AS DATE) AS gl_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'O'),
rate_days AS (
  SELECT DISTINCT conversion_date FROM (
    SELECT CAST(o_orderdate AS DATE) AS conversion_date FROM orders
    UNION ALL SELECT CAST(o_orderdate AS DATE) + 10 AS conversion_date FROM orders) d
  WHERE EXTRACT(DAY FROM conversion_date) <> 13),
gl_daily_rates AS (
  SELECT conversion_date, 'USD' AS from_currency, 'KES' AS to_currency,
         CAST(100 + EXTRACT(MONTH FROM conversion_date) + EXTRACT(DAY FROM conversion_date) * CAST(0.25 AS DECIMAL(4,2))
              AS DECIMAL(10,4)) AS conversion_rate FROM rate_days
  UNION ALL
  SELECT conversion_date, 'EUR' AS from_currency, 'KES' AS to_currency,
         CAST(120 + EXTRACT(MONTH FROM conversion_date) + EXTRACT(DAY FROM conversion_date) * CAST(0.25 AS DECIMAL(4,2))
              AS DECIMAL(10,4)) AS conversion_rate FROM rate_days)
"""


def with_derived(body: str, ctes: str = "") -> str:
    """``WITH <derived relations>[, <ctes>] <body>``."""
    extra = f",\n{ctes.strip()}" if ctes.strip() else ""
    return f"WITH {DERIVED_CTES.strip()}{extra}\n{body.strip()}"


# the variants of statera.sources.hazards
TIMES_OF_DAY = {
    **{name: f"SELECT * REPLACE (CAST({day} AS TIMESTAMP) + to_hours(CAST({key} % 24 AS INTEGER)) AS {day}) FROM {name}_base"
       for name, key, day in (("ap_invoices_all", "invoice_id", "invoice_date"), ("iby_payments_all", "payment_id", "payment_date"),
                              ("ra_customer_trx_all", "customer_trx_id", "trx_date"),
                              ("ar_cash_receipts_all", "cash_receipt_id", "receipt_date"))},
    "poz_suppliers_v": "SELECT * REPLACE (if(vendor_id % 10 = 3, NULL, vendor_name) AS vendor_name, "
                       "if(vendor_id % 10 = 7, NULL, segment1) AS segment1) FROM poz_suppliers_v_base",
}
DUPLICATE_RATES = {"gl_daily_rates": """
  SELECT * FROM gl_daily_rates_base
  UNION ALL SELECT * REPLACE (CAST(conversion_rate + 1 AS DECIMAL(10,4)) AS conversion_rate) FROM gl_daily_rates_base
            WHERE day(conversion_date) = 17
  UNION ALL SELECT DISTINCT conversion_date, 'KES', 'KES', CAST(r AS DECIMAL(10,4)) FROM gl_daily_rates_base, (VALUES (1), (2)) v(r)
            WHERE day(conversion_date) = 17"""}


def with_variant(variant: dict[str, str], body: str, ctes: str = "") -> str:
    """``with_derived`` on relations changed by ``variant`` (their SQL over ``<relation>_base``)."""
    base = re.sub(rf"\b({'|'.join(variant)})\b", r"\1_base", DERIVED_CTES.strip())
    changed = ",\n".join(f"{name} AS ({sql})" for name, sql in variant.items())
    return f"WITH {base},\n{changed}{',' if ctes.strip() else ''}\n{ctes.strip()}\n{body.strip()}"
