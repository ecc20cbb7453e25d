"""SQL counterparts of the registered queries, for DuckDB over the same parquet tables."""

from __future__ import annotations

from fixtures import invoice_tables, small_forest
from paperwarden.functions import fixed_values as fv

KINDS = "[" + ",".join(f"'{kind}'" for kind in invoice_tables.KINDS) + "]"

# For every start in a, the length of the longest run of letters that b holds too.
LONGEST = ("list_transform(range(1, length(a) + 1), lambda i: "
           "len(list_filter(range(1, length(a) - i + 2), lambda k: contains(b, substr(a, i, k))))) AS runs")

# ``alike`` rates every unknown name against every vendor: the longest common run, then the same left and right of it.
INVOICES = """
items AS (
  SELECT l_orderkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
    CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS net, CAST(l_tax AS DECIMAL(4,2)) AS rate,
    'part ' || l_partkey || ': ' || CAST(l_quantity AS INT) || ' pieces, ' || price AS goods FROM lineitem),
totals AS (
  SELECT l_orderkey, l_suppkey, CAST(round(sum(net), 2) AS DOUBLE) AS subtotal, CAST(round(sum(net * rate), 2) AS DOUBLE) AS tax,
    string_agg(goods, chr(10) ORDER BY goods) AS goods
  FROM items GROUP BY l_orderkey, l_suppkey),
invoices AS (
  SELECT l_orderkey || '/' || l_suppkey AS invoice_number, s_name AS vendor_name,
    CAST(o_orderdate AS DATE) AS invoice_date,
    CAST(CAST(o_orderdate AS DATE) + ([15,30,45,60])[CAST(s_suppkey % 4 AS INT) + 1] AS DATE) AS due_date,
    'NET' || ([15,30,45,60])[CAST(s_suppkey % 4 AS INT) + 1] AS payment_terms,
    'B' || l_orderkey AS po_number, subtotal, tax, round(subtotal + tax, 2) AS total_amount, goods,
    l_orderkey AS order_key, l_suppkey AS supplier_key
  FROM totals JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey),
history AS (SELECT * FROM invoices WHERE invoice_date < DATE '2001-01-01'),
last_numbers AS (SELECT vendor_name, max(invoice_number) AS past_number FROM history GROUP BY vendor_name),
said AS (
  SELECT i.* EXCLUDE (vendor_name, invoice_number, due_date, subtotal, tax, total_amount),
    (KINDS)[CAST(order_key % len(KINDS) AS INT) + 1] AS kind, 'text-' || order_key || '-' || supplier_key AS doc_id,
    CASE kind WHEN 'letter_lost' THEN replace(vendor_name, 'pp', 'p') WHEN 'digit_unreadable' THEN vendor_name[:-2] || 'x'
      WHEN 'sign_replaced' THEN replace(vendor_name, '#', ' ') ELSE vendor_name END AS vendor_name,
    CASE kind WHEN 'number_again' THEN coalesce(past_number, invoice_number) WHEN 'nothing_to_book' THEN ''
      ELSE invoice_number END AS invoice_number,
    CASE WHEN kind = 'due_early' THEN CAST(invoice_date - 3 AS DATE) ELSE due_date END AS due_date,
    CASE kind WHEN 'too_large' THEN round(subtotal * 35, 2) WHEN 'even_sum' THEN 3000.0 ELSE subtotal END AS subtotal,
    CASE kind WHEN 'too_large' THEN round(tax * 35, 2) WHEN 'even_sum' THEN 150.0 ELSE tax END AS tax,
    invoice_date >= DATE '2001-01-01' AS arriving
  FROM invoices i LEFT JOIN last_numbers p USING (vendor_name)),
shown AS (
  SELECT *, kind = 'short_labels' AS short,
    CASE kind WHEN 'month_as_word' THEN strftime(due_date, '%b %-d, %Y') WHEN 'slashes' THEN strftime(due_date, '%m/%d/%Y')
      WHEN 'day_first' THEN strftime(due_date, '%-d %B %Y') ELSE strftime(due_date, '%Y-%m-%d') END AS due_shown,
    CASE WHEN kind = 'month_unreadable' THEN strftime(invoice_date, '%Y-XX-%d') ELSE
      CASE kind WHEN 'month_as_word' THEN strftime(invoice_date, '%b %-d, %Y') WHEN 'slashes' THEN strftime(invoice_date, '%m/%d/%Y')
      WHEN 'day_first' THEN strftime(invoice_date, '%-d %B %Y') ELSE strftime(invoice_date, '%Y-%m-%d') END END AS invoice_shown,
    CASE WHEN kind = 'nothing_to_book' AND (order_key // len(KINDS)) % 2 = 1 THEN NULL
      WHEN kind = 'sum_wrong' THEN round(subtotal + tax - 31.5::DOUBLE, 2)
      ELSE round(subtotal + tax, 2) END AS total_amount,
    coalesce(format('{:,.2f}', total_amount), 'to follow') AS total_shown
  FROM said),
bodies AS (
  SELECT doc_id, kind, arriving, concat_ws(chr(10), vendor_name, 'Goods sent for order ' || order_key, goods,
      CASE WHEN short THEN 'Sub-total: ' ELSE 'Subtotal ' END || format('{:,.2f}', subtotal),
      CASE WHEN short THEN 'TAX - ' ELSE 'Tax ' END || format('{:,.2f}', tax),
      CASE WHEN short THEN 'Total - ' ELSE 'Total amount due ' END || total_shown,
      CASE WHEN short THEN 'Payment terms ' ELSE 'Payment terms - ' END || payment_terms,
      'Due date - ' || due_shown,
      CASE WHEN short THEN 'Invoice no ' ELSE 'Invoice # ' END || invoice_number,
      'Invoice date - ' || invoice_shown,
      CASE WHEN short THEN 'P.O. no. ' ELSE 'PO # ' END || po_number,
      CASE kind WHEN 'paid_yet_owed' THEN 'Thank you, paid in full. Open balance due: ' || total_shown
                WHEN 'two_versions' THEN 'A draft; the final sheet comes by mail.' END) AS body
  FROM shown),
docs AS (
  SELECT doc_id, kind, arriving, CASE WHEN kind = 'other_line_ends'
      THEN chr(9) || chr(13) || chr(10) || replace(body, chr(10), chr(13) || chr(10)) ELSE body END AS raw_text
  FROM bodies),
alike AS (
  WITH RECURSIVE asked AS (
    SELECT DISTINCT vendor_name FROM said WHERE arriving AND vendor_name NOT IN (SELECT vendor_name FROM history)),
  parts AS (
    SELECT n.vendor_name, h.vendor_name AS known, lower(n.vendor_name) AS a, lower(h.vendor_name) AS b, LONGEST
    FROM asked n CROSS JOIN (SELECT DISTINCT vendor_name FROM history) h
    UNION ALL
    SELECT vendor_name, known, a, b, LONGEST FROM (
      SELECT vendor_name, known, unnest([a[:i - 1], a[i + n:]]) AS a, unnest([b[:j - 1], b[j + n:]]) AS b
      FROM (SELECT *, list_max(runs) AS n, list_position(runs, list_max(runs)) AS i,
              instr(b, substr(a, list_position(runs, list_max(runs)), list_max(runs))) AS j FROM parts WHERE list_max(runs) > 0))
    WHERE a <> '' AND b <> ''),
  scored AS (
    SELECT vendor_name, known, 2 * sum(list_max(runs)) / (length(vendor_name) + length(known)) AS ratio
    FROM parts GROUP BY vendor_name, known)
  SELECT vendor_name, known AS closest_vendor, ratio::DOUBLE AS ratio FROM scored
  QUALIFY row_number() OVER (PARTITION BY vendor_name ORDER BY ratio DESC, known) = 1 AND ratio BETWEEN 0.8 AND 0.98 - 1e-12)
""".replace("KINDS", KINDS).replace("LONGEST", LONGEST)

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _pattern(p: str) -> str:
    return p.replace("'", "''")


def _found(p: str, text: str = "raw_text") -> str:
    return f"nullif(trim(regexp_extract({text}, '{_pattern(p)}', 1, 'i'), {BLANKS}), '')"


# RE2 has no look-behind: 'sub-total' is masked first; the look-ahead can never decide, as no '(' may follow.
TOTAL_2 = r"\btotal\b\s*(?:amount)?\s*(?:due)?\s*[:\-]?\s*\$?\s*([\d,]+\.\d{2})"
MASKED = "regexp_replace(raw_text, 'sub-total', 'sub-xxxxx', 'gi')"

FIELDS = INVOICES + ",\nraws AS (\n  SELECT doc_id, kind, arriving, raw_text,\n" + (
    f"    trim(regexp_extract(trim(raw_text, {BLANKS}), '^[^\\n\\r]*'), {BLANKS}) AS vendor_name,\n"
) + ",\n".join(
    f"    {_found(fv.FIELD_PATTERNS[name][0])} AS {name}_raw" for name in fv.FIELD_PATTERNS if name != "total_amount"
) + f""",
    coalesce({_found(fv.FIELD_PATTERNS["total_amount"][0])}, {_found(TOTAL_2, MASKED)}) AS total_amount_raw,
    contains(lower(raw_text), 'paid in full') AS mentions_paid_in_full,
    regexp_matches(lower(raw_text), 'balance\\s*due') AS mentions_balance_due,
    contains(lower(raw_text), 'draft') AS mentions_draft, contains(lower(raw_text), 'final') AS mentions_final
  FROM docs),
parsed AS (
  SELECT *,
    CAST(try_strptime(invoice_date_raw, ['%Y-%m-%d', '%m/%d/%Y', '%b %d, %Y', '%d %B %Y']) AS DATE) AS invoice_date_dt,
    CAST(try_strptime(due_date_raw, ['%Y-%m-%d', '%m/%d/%Y', '%b %d, %Y', '%d %B %Y']) AS DATE) AS due_date_dt,
    CAST(replace(subtotal_raw, ',', '') AS DOUBLE) AS subtotal, CAST(replace(tax_raw, ',', '') AS DOUBLE) AS tax,
    CAST(replace(total_amount_raw, ',', '') AS DOUBLE) AS total_amount
  FROM raws),
fields AS (
  SELECT *, coalesce(strftime(invoice_date_dt, '%Y-%m-%d'), invoice_date_raw) AS invoice_date,
    coalesce(strftime(due_date_dt, '%Y-%m-%d'), due_date_raw) AS due_date,
    invoice_number_raw AS invoice_number, po_number_raw AS po_number, payment_terms_raw AS payment_terms
  FROM parsed)"""

PROFILES = """
profiles AS (
  SELECT a.vendor_name, amount_mean, amount_std, typical_terms,
    CAST(nullif(regexp_replace(typical_terms, '[^0-9]', '', 'g'), '') AS INT) AS typical_net_days, invoice_count
  FROM (SELECT vendor_name, avg(total_amount) AS amount_mean,
          CASE WHEN count(total_amount) > 1 THEN greatest(stddev_samp(total_amount), 1e-6) END AS amount_std,
          count(*) AS invoice_count
        FROM history WHERE vendor_name IS NOT NULL GROUP BY vendor_name) a
  LEFT JOIN (SELECT vendor_name, payment_terms AS typical_terms FROM (
          SELECT vendor_name, payment_terms, row_number() OVER (
            PARTITION BY vendor_name ORDER BY count(*) DESC, payment_terms) AS place
          FROM history WHERE payment_terms IS NOT NULL GROUP BY vendor_name, payment_terms) WHERE place = 1) b
  USING (vendor_name)),
overall AS (
  SELECT avg(total_amount) AS amount_mean,
    CASE WHEN count(total_amount) > 1 THEN greatest(stddev_samp(total_amount), 1e-6) END AS amount_std,
    max(invoice_date) AS latest_date, count(*) AS invoice_count FROM history)"""


def _features(source: str, key: str, text: str, invoiced: str, due: str) -> str:
    return f"""
  SELECT {key}, coalesce(d.subtotal, 0.0) AS subtotal,
    coalesce(d.tax / nullif(d.subtotal, 0), 0.0) AS tax_ratio,
    (coalesce(d.total_amount, 0.0) - coalesce(p.amount_mean, o.amount_mean))
      / CASE WHEN p.vendor_name IS NULL THEN o.amount_std ELSE p.amount_std END AS zscore,
    CAST(coalesce({due} - {invoiced}, 0) AS DOUBLE) AS days_invoice_to_due,
    CAST(coalesce(abs(({due} - {invoiced}) - p.typical_net_days), 0) AS DOUBLE) AS days_terms_deviation,
    CASE WHEN isodow({invoiced}) >= 6 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_weekend_invoice_date,
    CASE WHEN p.vendor_name IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS vendor_seen_before,
    CAST(length({text}) AS DOUBLE) AS text_length,
    coalesce(length(regexp_replace({text}, '[^0-9]', '', 'g')) / nullif(length({text}), 0), 0.0) AS digit_density,
    CAST(coalesce({invoiced} - o.latest_date, 0) AS DOUBLE) AS days_since_latest_history
  FROM {source} d LEFT JOIN profiles p ON d.vendor_name = p.vendor_name CROSS JOIN overall o"""


DOC_FEATURES = FIELDS + "," + PROFILES + ",\nfeatures AS (" + _features(
    "(SELECT * FROM fields WHERE arriving)", "d.doc_id", "d.raw_text", "d.invoice_date_dt", "d.due_date_dt") + ")"
HISTORY_FEATURES = INVOICES + "," + PROFILES + ",\nfeatures AS (" + _features(
    "history", "d.invoice_number",
    "(d.vendor_name || ' ' || d.invoice_number || ' ' || CAST(d.total_amount AS VARCHAR))",
    "d.invoice_date", "d.due_date") + ")"
ROUNDED_FEATURES = ", ".join(
    f"round(coalesce(zscore, 0.0), 6) AS {n}" if n == "amount_zscore_vs_vendor" else f"round({n}, 6) AS {n}"
    for n in fv.FEATURE_NAMES)
VECTOR = ", ".join("coalesce(zscore, 0.0) AS amount_zscore_vs_vendor" if n == "amount_zscore_vs_vendor" else n
                   for n in fv.FEATURE_NAMES)


def _message(name: str, **values: str) -> str:
    text = "'" + fv.MESSAGES[name].replace("'", "''") + "'"
    for key, value in values.items():
        text = f"replace({text}, '{{{key}}}', {value})"
    return text


def _money(column: str) -> str:
    return f"format('{{:,.2f}}', {column})"


def _rule(source: str, no: int, category: str, severity: str, condition: str, message: str) -> str:
    return (f"SELECT doc_id, {no} AS rule_no, '{category}' AS category, {severity} AS severity, {message} AS message "
            f"FROM {source} WHERE {condition}")


MISSING = """list_filter([
    CASE WHEN coalesce(invoice_number, '') = '' THEN 'invoice_number' END,
    CASE WHEN coalesce(invoice_date, '') = '' THEN 'invoice_date' END,
    CASE WHEN coalesce(total_amount, 0) = 0 THEN 'total_amount' END,
    CASE WHEN coalesce(vendor_name, '') = '' THEN 'vendor_name' END], lambda x: x IS NOT NULL)"""


def _rules(source: str) -> dict[str, list[str]]:
    iso = {c: f"strftime({c}_date_dt, '%Y-%m-%d')" for c in ("invoice", "due")}
    return {
        "missing": [_rule(source, 1, "missing_fields", f"CASE WHEN len({MISSING}) > 1 THEN 'high' ELSE 'medium' END",
                          f"len({MISSING}) > 0",
                          _message("missing_fields", missing=f"array_to_string({MISSING}, ', ')"))],
        "date_format": [
            _rule(source, 2, "date_format", "'medium'", "invoice_date_raw IS NOT NULL AND invoice_date_dt IS NULL",
                  _message("invoice_date_format", invoice_date_raw="invoice_date_raw")),
            _rule(source, 3, "date_format", "'low'", "due_date_raw IS NOT NULL AND due_date_dt IS NULL",
                  _message("due_date_format", due_date_raw="due_date_raw"))],
        "date_logic": [
            _rule(source, 4, "date_logic", "'high'", "due_date_dt < invoice_date_dt",
                  _message("due_before_invoice", due=iso["due"], invoiced=iso["invoice"])),
            _rule(source, 5, "date_logic", "'high'", "invoice_date_dt > DATE '2001-06-30'",
                  _message("future_date", invoiced=iso["invoice"], today="'2001-06-30'"))],
        "arithmetic": [_rule(
            source, 6, "arithmetic", "'high'", "abs(round(subtotal + tax, 2) - total_amount) > 0.02",
            _message("arithmetic", total=_money("total_amount"), subtotal=_money("subtotal"), tax=_money("tax"),
                     expected=_money("round(subtotal + tax, 2)"),
                     difference=_money("abs(round(subtotal + tax, 2) - total_amount)")))],
        "round": [_rule(
            source, 7, "round_numbers", "'low'",
            "subtotal >= 1000 AND round(subtotal, 0) = subtotal AND total_amount <> 0 "
            "AND round(total_amount, 0) = total_amount", _message("round_numbers", subtotal=_money("subtotal")))],
        "outlier": [_rule(
            source, 8, "amount_outlier", "CASE WHEN abs(zscore) >= 5 THEN 'high' ELSE 'medium' END",
            "abs(zscore) >= 3", _message("amount_outlier", z="format('{:.1f}', abs(zscore))",
                                         direction="CASE WHEN zscore > 0 THEN 'higher' ELSE 'lower' END"))],
        "duplicate": [_rule(source, 9, "duplicate", "'high'",
                            "invoice_number IN (SELECT invoice_number FROM history)",
                            _message("duplicate", invoice_number="invoice_number"))],
        "lookalike": [_rule(
            f"(SELECT * FROM {source} JOIN alike USING (vendor_name))", 10, "vendor_lookalike", "'high'", "true",
            _message("vendor_lookalike", vendor_name="vendor_name", percent="format('{:.0f}', ratio * 100)",
                     closest_vendor="closest_vendor"))],
        "conflict": [
            _rule(source, 11, "conflicting_statement", "'high'",
                  "mentions_paid_in_full AND mentions_balance_due AND total_amount > 0",
                  _message("paid_and_due", total=_money("total_amount"))),
            _rule(source, 12, "conflicting_statement", "'medium'", "mentions_draft AND mentions_final",
                  _message("draft_and_final"))],
    }


def _rule_query(name: str) -> str:
    return (f"WITH {FIELDS} SELECT doc_id, category, severity, message FROM ("
            + " UNION ALL ".join(_rules("fields")[name]) + ")")


CHECKED = DOC_FEATURES + """,
checked AS (SELECT f.*, features.zscore FROM fields f JOIN features USING (doc_id)),
flags AS (""" + " UNION ALL ".join(s for part in _rules("checked").values() for s in part) + """),
ranked AS (SELECT *, CASE severity WHEN 'low' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END AS weight,
  row_number() OVER (PARTITION BY doc_id ORDER BY rule_no) - 1 AS flag_no FROM flags),
risks AS (
  SELECT c.doc_id, CAST(coalesce(sum(weight), 0) AS INT) AS risk_weight,
    CASE WHEN coalesce(sum(weight), 0) <= 2 THEN 'Low' WHEN coalesce(sum(weight), 0) <= 5 THEN 'Medium'
         ELSE 'High' END AS risk_level, count(category) AS issues
  FROM checked c LEFT JOIN ranked r USING (doc_id) GROUP BY c.doc_id),
reasons AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, rule_no) - 1 AS INT) AS reason_no,
    'rule' AS source, category, severity, message FROM ranked
  UNION ALL
  SELECT doc_id, 0, 'summary', 'clean', 'low', """ + _message("clean") + """ FROM risks WHERE issues = 0)"""


def _stop_list() -> str:
    return "(" + ", ".join(f"'{w}'" for w in fv.STOP_WORDS) + ")"


TERMS = f"""
words AS (
  SELECT doc_id, list_filter(regexp_extract_all(lower(coalesce(text, '')), '{fv.TOKEN_PATTERN}'),
                             lambda w: w NOT IN {_stop_list()}) AS words
  FROM documents),
tf AS (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(words) AS term FROM words
    UNION ALL
    SELECT doc_id, words[i] || ' ' || words[i + 1] FROM (
      SELECT doc_id, words, unnest(range(1, len(words))) AS i FROM words))
  GROUP BY doc_id, term),
raw_weights AS (
  SELECT doc_id, term, tf, df, tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0) AS weight
  FROM tf JOIN (SELECT term, count(*) AS df FROM tf GROUP BY term) USING (term)),
weights AS (
  SELECT doc_id, term, tf, df, weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS weight
  FROM raw_weights)"""

PAIRS = TERMS + """,
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, sum(a.weight * b.weight) AS similarity
  FROM weights a JOIN weights b ON a.term = b.term AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING sum(a.weight * b.weight) >= 0.92),
both_ways AS (SELECT a AS doc_id, b AS partner, similarity FROM pairs
              UNION ALL SELECT b, a, similarity FROM pairs)"""

# The factored form: bags (same token sequence), shared terms (in more than one bag), cores.
CORES = TERMS + """,
bag_of AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN doc_id
             ELSE min(doc_id) OVER (PARTITION BY array_to_string(words, ' ')) END AS copy_of FROM words),
shared AS (SELECT term FROM tf JOIN bag_of USING (doc_id) GROUP BY term HAVING count(DISTINCT copy_of) > 1),
core_of AS (
  SELECT doc_id, sqrt(coalesce(sum(weight * weight) FILTER (shared.term IS NOT NULL), 0)) AS rho,
    string_agg(w.term || ' ' || tf, ' ' ORDER BY w.term) FILTER (shared.term IS NOT NULL) AS signature
  FROM weights w LEFT JOIN shared USING (term) GROUP BY doc_id),
placed AS (
  SELECT b.doc_id, copy_of, coalesce(rho, 0) AS rho, CASE WHEN rho >= 0.92 THEN signature END AS signature
  FROM bag_of b LEFT JOIN core_of USING (doc_id)),
grouped AS (
  SELECT doc_id, copy_of, rho, signature,
    CASE WHEN signature IS NOT NULL THEN min(doc_id) OVER (PARTITION BY signature)
         ELSE copy_of END AS group_id
  FROM placed)"""


NUMBERED = ", ".join(f"coalesce(zscore, 0.0) AS x{i}" if n == "amount_zscore_vs_vendor" else f"{n} AS x{i}"
                     for i, n in enumerate(fv.FEATURE_NAMES))
SMALL_FOREST = DOC_FEATURES + ", past_features AS (" + _features(
    "history", "d.invoice_number",
    "(d.vendor_name || ' ' || d.invoice_number || ' ' || CAST(d.total_amount AS VARCHAR))",
    "d.invoice_date", "d.due_date") + f"""),
numbered AS (SELECT doc_id, {NUMBERED} FROM features),
scored AS (SELECT *, {small_forest.score_sql()} AS score FROM numbered),
past_scores AS (SELECT score, count(*) AS n FROM (
  SELECT {small_forest.score_sql()} AS score FROM (SELECT {NUMBERED} FROM past_features)) GROUP BY score)"""


def _fixed_report() -> str:
    """Rules, small forest and near-duplicates of the arriving invoices and the resent ones.

    Pairs are taken from terms of less than 200 documents; by the inequality of Cauchy and Schwarz a pair without such
    a term can only reach 0.92 if the frequent terms of both documents make up as much of their lengths.
    """
    sent = """batch AS (SELECT doc_id, kind, arriving, raw_text FROM docs UNION ALL
  SELECT doc_id || '-again', kind, arriving, raw_text || chr(10) || 'Second sending' FROM docs
  WHERE arriving AND split_part(doc_id, '-', 2)::BIGINT % 7 = 0),
alike AS (
"""
    checked = CHECKED.replace("alike AS (\n", sent, 1).replace("FROM docs),\nparsed", "FROM batch),\nparsed", 1)
    terms = TERMS.replace("FROM documents", "FROM batch WHERE arriving").replace("coalesce(text, '')", "coalesce(raw_text, '')")
    explained = "CASE f.feature " + " ".join(
        f"WHEN '{n}' THEN '{t.replace("'", "''")}'" for n, t in fv.FEATURE_EXPLANATIONS.items()) + " END"
    return f"""WITH {checked}{SMALL_FOREST[len(DOC_FEATURES):]},
{terms},
rare AS (SELECT doc_id, term FROM weights WHERE df < 200),
plain AS (SELECT doc_id, sqrt(sum(weight * weight)) AS part FROM weights WHERE df >= 200 GROUP BY doc_id HAVING part >= 0.92),
candidates AS (SELECT a.doc_id AS a, b.doc_id AS b FROM rare a JOIN rare b ON a.term = b.term AND a.doc_id < b.doc_id
  UNION SELECT a.doc_id, b.doc_id FROM plain a JOIN plain b ON a.doc_id < b.doc_id),
pairs AS (SELECT a, b, sum(x.weight * y.weight) AS similarity FROM candidates JOIN weights x ON x.doc_id = a
  JOIN weights y ON y.doc_id = b AND y.term = x.term GROUP BY a, b HAVING sum(x.weight * y.weight) >= 0.92),
near AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM (
    SELECT a AS doc_id, b AS partner, similarity FROM pairs UNION ALL SELECT b, a, similarity FROM pairs)
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(similarity, 9) DESC, partner) = 1),
model AS (SELECT doc_id, score, {small_forest.attributions_sql()}[1:3] AS top, (SELECT coalesce(sum(n), 0) FROM past_scores p
    WHERE p.score < s.score)::DOUBLE / (SELECT sum(n) FROM past_scores)::DOUBLE * 100.0::DOUBLE AS percentile FROM scored s),
messages AS (
  SELECT doc_id, reason_no AS place, message FROM reasons WHERE source = 'rule'
  UNION ALL SELECT doc_id, 1000 + place, {_message("pattern_deviation", explanation=explained, value="format('{:.2f}', f.value)",
                                                   contribution="format('{:.2f}', f.contribution)")}
    FROM (SELECT doc_id, place, top[place] AS f FROM (SELECT doc_id, top, unnest(range(1, 4)) AS place FROM model))
    WHERE f.contribution > 0.05
  UNION ALL SELECT doc_id, 2000, {_message("near_duplicate", percent="format('{:.0f}', similarity * 100)", other="partner")}
    || CASE WHEN n > 1 THEN ' ' || {_message("near_duplicate_count", count="CAST(n AS VARCHAR)")} ELSE '' END FROM near),
whole AS (SELECT r.doc_id, risk_weight + CASE WHEN percentile >= 95 THEN 2 WHEN percentile >= 85 THEN 1 ELSE 0 END
    + CASE WHEN n IS NULL THEN 0 ELSE 2 END AS weight, score, percentile
  FROM risks r JOIN model USING (doc_id) LEFT JOIN near USING (doc_id))
SELECT doc_id, CASE WHEN weight <= 2 THEN 'Low' WHEN weight <= 5 THEN 'Medium' ELSE 'High' END AS risk_level,
  round(score, 4) AS ml_anomaly_score, round(percentile, 1) AS ml_anomaly_percentile, vendor_name, invoice_number,
  invoice_date, due_date, po_number, payment_terms, subtotal, tax, total_amount,
  coalesce(messages, {_message("clean")}) AS messages
FROM whole JOIN checked USING (doc_id)
LEFT JOIN (SELECT doc_id, string_agg(message, ' | ' ORDER BY place) AS messages FROM messages GROUP BY doc_id) USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "fixed_forest_scores": f"""WITH {SMALL_FOREST} SELECT doc_id, round(score, 6) AS score, round(
            (SELECT coalesce(sum(n), 0) FROM past_scores p WHERE p.score < s.score)::DOUBLE
            / (SELECT sum(n) FROM past_scores)::DOUBLE * 100.0::DOUBLE, 6) AS percentile FROM scored s""",
        "fixed_forest_attributions": f"""WITH {SMALL_FOREST}, listed AS (
              SELECT doc_id, {small_forest.attributions_sql()}[1:3] AS top FROM scored)
            SELECT doc_id, place::INT AS place, top[place + 1].feature AS feature,
              round(top[place + 1].value, 6) + 0.0::DOUBLE AS value,
              round(top[place + 1].contribution, 6) + 0.0::DOUBLE AS contribution
            FROM (SELECT *, unnest(range(3)) AS place FROM listed)""",
        "extract_fields": f"""WITH {FIELDS} SELECT doc_id, vendor_name, invoice_number_raw, po_number_raw,
            payment_terms_raw, invoice_date_raw, due_date_raw, subtotal_raw, tax_raw, total_amount_raw FROM fields""",
        "extract_phrases": f"""WITH {FIELDS} SELECT doc_id, mentions_paid_in_full, mentions_balance_due,
            mentions_draft, mentions_final FROM fields""",
        "clean_dates": f"""WITH {FIELDS} SELECT doc_id, invoice_date, invoice_date_dt,
            invoice_date_dt IS NOT NULL AS invoice_date_parse_ok, due_date, due_date_dt,
            due_date_dt IS NOT NULL AS due_date_parse_ok FROM fields""",
        "clean_money": f"WITH {FIELDS} SELECT doc_id, subtotal, tax, total_amount FROM fields",
        "vendor_profiles": f"""WITH {INVOICES}, {PROFILES} SELECT vendor_name, round(amount_mean, 4) AS amount_mean,
            round(amount_std, 4) AS amount_std, typical_terms, typical_net_days, invoice_count FROM profiles""",
        "global_profile": f"""WITH {INVOICES}, {PROFILES} SELECT round(amount_mean, 4) AS amount_mean,
            round(amount_std, 4) AS amount_std, latest_date, invoice_count FROM overall""",
        "known_keys": f"""WITH {INVOICES} SELECT DISTINCT 'invoice_number' AS kind, invoice_number AS key FROM history
            UNION ALL SELECT DISTINCT 'vendor_name', vendor_name FROM history
            UNION ALL SELECT DISTINCT 'vendor_invoice', vendor_name || '|' || invoice_number FROM history""",
        "doc_features": f"WITH {DOC_FEATURES} SELECT doc_id, {ROUNDED_FEATURES} FROM features",
        "history_features": f"WITH {HISTORY_FEATURES} SELECT invoice_number, {ROUNDED_FEATURES} FROM features",
        "scaler_stats": f"WITH {HISTORY_FEATURES}, vectors AS (SELECT {VECTOR} FROM features) " + " UNION ALL ".join(
            f"SELECT '{n}' AS feature, round(avg({n}), 4) AS mean, "
            f"round(CASE WHEN stddev_pop({n}) = 0 THEN 1.0 ELSE stddev_pop({n}) END, 4) AS std FROM vectors"
            for n in fv.FEATURE_NAMES),
        "feature_medians": f"WITH {HISTORY_FEATURES}, vectors AS (SELECT {VECTOR} FROM features) " + " UNION ALL ".join(
            f"SELECT '{n}' AS feature, round(median({n}), 6) AS median FROM vectors" for n in fv.FEATURE_NAMES),
        "flags_long": f"""WITH {CHECKED} SELECT doc_id, CAST(flag_no AS INT) AS flag_no, category, severity, message
            FROM ranked""",
        "flag_counts": f"WITH {CHECKED} SELECT category, severity, count(*) AS flags FROM ranked GROUP BY ALL",
        "risk_levels": f"WITH {CHECKED} SELECT doc_id, risk_weight, risk_level FROM risks",
        "reasons": f"WITH {CHECKED} SELECT doc_id, reason_no, source, category, severity, message FROM reasons",
        "rule_report": f"""WITH {CHECKED} SELECT doc_id, risk_level, vendor_name, invoice_number, invoice_date,
            due_date, po_number, payment_terms, subtotal, tax, total_amount, messages
            FROM checked JOIN risks USING (doc_id) JOIN (
              SELECT doc_id, string_agg(message, ' | ' ORDER BY reason_no) AS messages FROM reasons GROUP BY doc_id)
            USING (doc_id)""",
        "summary_lines": f"""WITH {CHECKED} SELECT doc_id, '[' || CASE risk_level WHEN 'High' THEN ' HIGH '
            WHEN 'Medium' THEN 'MEDIUM' ELSE ' LOW  ' END || '] ' || doc_id || ' — ' || issues ||
            ' issue(s) flagged' AS summary FROM risks""",
        "detection_table": f"""WITH {CHECKED} SELECT kind AS ground_truth_note, count(*) AS documents,
            count(*) FILTER (issues > 0) AS flagged, round(count(*) FILTER (issues > 0) / count(*), 4) AS recall
            FROM checked JOIN risks USING (doc_id) GROUP BY kind""",
        "vendor_lookalikes": f"""WITH {INVOICES} SELECT vendor_name, closest_vendor,
            round(ratio, 6) AS vendor_similarity FROM alike""",
        "percentiles": f"""WITH {INVOICES}, past AS (
              SELECT total_amount, count(*) AS n FROM history GROUP BY total_amount),
            running AS (SELECT total_amount, sum(n) OVER (ORDER BY total_amount) AS upto FROM past),
            arriving AS (SELECT doc_id, total_amount FROM shown WHERE arriving)
            SELECT doc_id, total_amount AS score,
              CASE WHEN total_amount IS NOT NULL THEN
                round(coalesce(r.upto, 0) / (SELECT count(*) FROM history) * 100, 6) END AS percentile
            FROM arriving a ASOF LEFT JOIN (
              SELECT total_amount AS at, upto FROM running) r ON a.total_amount > r.at""",
        "ml_reasons": f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, category, severity, message FROM (
            SELECT *, 'pattern_deviation:subtotal' AS category,
              CASE WHEN l_discount < 0.3 THEN 'medium' ELSE 'high' END AS severity,
              {_message("pattern_deviation", explanation="'" + fv.FEATURE_EXPLANATIONS["subtotal"] + "'",
                        value="format('{:.2f}', l_extendedprice)", contribution="format('{:.2f}', l_discount)")} AS message
            FROM lineitem WHERE l_discount > 0.05
            UNION ALL
            SELECT *, 'pattern_deviation:tax_ratio', CASE WHEN l_tax * 10 < 0.3 THEN 'medium' ELSE 'high' END,
              {_message("pattern_deviation", explanation="'" + fv.FEATURE_EXPLANATIONS["tax_ratio"] + "'",
                        value="format('{:.2f}', l_quantity)", contribution="format('{:.2f}', l_tax * 10)")}
            FROM lineitem WHERE l_tax * 10 > 0.05)""",
        "combined_risk": f"""WITH {CHECKED}, past AS (
              SELECT total_amount, count(*) AS n FROM history GROUP BY total_amount),
            running AS (SELECT total_amount AS at, sum(n) OVER (ORDER BY total_amount) AS upto FROM past),
            shares AS (SELECT c.doc_id, coalesce(r.upto, 0) / (SELECT count(*) FROM history) * 100 AS percentile
              FROM checked c ASOF LEFT JOIN running r ON c.total_amount > r.at),
            summed AS (SELECT doc_id, CAST(risk_weight + CASE WHEN percentile >= 95 THEN 2 WHEN percentile >= 85
              THEN 1 ELSE 0 END AS INT) AS risk_weight FROM risks JOIN shares USING (doc_id))
            SELECT doc_id, risk_weight, CASE WHEN risk_weight <= 2 THEN 'Low' WHEN risk_weight <= 5 THEN 'Medium'
              ELSE 'High' END AS risk_level FROM summed""",
        "tfidf_weights": f"WITH {TERMS} SELECT doc_id, term, tf, round(weight, 6) AS weight FROM weights",
        "near_duplicates": f"""WITH {PAIRS} SELECT doc_id, count(*) AS n_partners,
            round(max(similarity), 6) AS best_similarity FROM both_ways GROUP BY doc_id""",
        "near_dup_groups": f"WITH {CORES} SELECT doc_id, copy_of, group_id, round(rho, 6) AS rho FROM grouped",
        "near_dup_links": f"""WITH {CORES}, heads AS (
              SELECT group_id, max(rho) AS best_rho, count(*) AS docs, any_value(rho) FILTER (doc_id = group_id) AS rho
              FROM grouped WHERE signature IS NOT NULL GROUP BY group_id),
            unit AS (SELECT group_id, term, weight / rho AS weight, best_rho, docs
              FROM heads JOIN weights ON doc_id = group_id)
            SELECT a.group_id AS group_a, b.group_id AS group_b, round(sum(a.weight * b.weight), 6) AS similarity,
              any_value(a.docs) AS docs_a, any_value(b.docs) AS docs_b
            FROM unit a JOIN unit b ON a.term = b.term AND a.group_id < b.group_id
            GROUP BY a.group_id, b.group_id
            HAVING sum(a.weight * b.weight) * any_value(a.best_rho) * any_value(b.best_rho) >= 0.92""",
        "near_dup_reasons": f"""WITH {PAIRS}, ranked AS (
              SELECT *, count(*) OVER (PARTITION BY doc_id) AS n, row_number() OVER (
                PARTITION BY doc_id ORDER BY round(similarity, 9) DESC, partner) AS place FROM both_ways)
            SELECT doc_id, n AS n_partners, 0::INT AS reason_no, {_message(
                "near_duplicate", percent="format('{:.0f}', similarity * 100)", other="CAST(partner AS VARCHAR)")}
              || CASE WHEN n > 1 THEN ' ' || {_message("near_duplicate_count", count="CAST(n AS VARCHAR)")}
                 ELSE '' END AS message FROM ranked WHERE place = 1""",
        "text_sources": """SELECT doc_id, md5(regexp_replace(text, '\\r\\n?', chr(10), 'g')) AS digest,
            length(text) AS text_length,
            round(coalesce(length(regexp_replace(text, '[^0-9]', '', 'g')) / nullif(length(text), 0), 0.0), 6)
              AS digit_density FROM documents""",
        "rejects": """SELECT url AS path, lower(regexp_extract(regexp_extract(url, '([^/]+)$', 1),
            '[^/](\\.[^./]*)$', 1)) AS ext, 'Unsupported file type: ' ||
            lower(regexp_extract(regexp_extract(url, '([^/]+)$', 1), '[^/](\\.[^./]*)$', 1)) AS reason FROM pages""",
    }
    sql["history_csv"] = f"""WITH {INVOICES} SELECT invoice_number, vendor_name, invoice_date, due_date, payment_terms,
        po_number, subtotal, tax, total_amount FROM history WHERE order_key % 50 > 3"""
    sql["history_rejects"] = f"""WITH {INVOICES}, told AS (SELECT order_key % 50 AS k, invoice_number || ',' || vendor_name
          || ',' || CASE WHEN k = 0 THEN 'soon' ELSE invoice_date::VARCHAR END || ',' || due_date || ',' || payment_terms
          || ',' || po_number || ',' || CASE WHEN k = 1 THEN 'n/a' ELSE subtotal::DECIMAL(18,2)::VARCHAR END
          || ',' || tax::DECIMAL(18,2) || CASE WHEN k = 2 THEN '' ELSE ',' || total_amount::DECIMAL(18,2) END
          || CASE WHEN k = 3 THEN ',one more' ELSE '' END AS line FROM history WHERE order_key % 50 <= 3)
        SELECT line, CASE k WHEN 0 THEN 'invoice_date: soon' WHEN 1 THEN 'subtotal: n/a' ELSE 'wrong number of values' END
          AS reason FROM told"""
    sql["report_batches"] = f"""WITH {CHECKED} SELECT doc_id, risk_level,
        CAST(split_part(doc_id, '-', 2)::BIGINT % 2 AS INT) AS batch FROM risks"""
    values = ", ".join(
        "round(coalesce(zscore, 0.0), 6)" if n == "amount_zscore_vs_vendor" else f"round({n}, 6)" for n in fv.FEATURE_NAMES)
    sql["feature_vectors"] = f"""WITH {DOC_FEATURES} SELECT doc_id, unnest(range({len(fv.FEATURE_NAMES)}))::INT AS place,
        unnest([{values}]) AS value FROM features"""
    sql["fixed_report"] = _fixed_report()
    sql["merged_profiles"] = sql["vendor_profiles"]
    for name in ("missing", "date_format", "date_logic", "arithmetic", "round", "conflict"):
        sql[f"rule_{name}"] = _rule_query(name)
    for name, category in (("outlier", "amount_outlier"), ("duplicate", "duplicate"),
                           ("lookalike", "vendor_lookalike")):
        sql[f"rule_{name}"] = (f"WITH {CHECKED} SELECT doc_id, category, severity, message FROM ranked "
                               f"WHERE category = '{category}'")
    return sql
