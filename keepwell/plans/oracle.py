"""ANSI-SQL twins of the named queries, written for DuckDB.

Each statement is a chain of common table expressions over the plain tables
and states the naive form of an operator: one big sort, one unpartitioned
window, one ``quantile_cont``. The Spark side has to give the same values.
"""

from __future__ import annotations

import re

from keepwell import contract as C

SAMPLE_ROWS = 100

_D = "DECIMAL(18,2)"


def _yn(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 'Yes' ELSE 'No' END"


def _net(cond: str) -> str:
    return f"CASE WHEN net THEN {_yn(cond)} END"


ACCOUNTS = f"""
history AS (
  SELECT o_custkey, COUNT(DISTINCT o_orderkey) AS n_orders,
         SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS {_D}) END) AS returned
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey),
bought AS (
  SELECT user_id, SUM(CAST(value AS {_D})) AS extra
  FROM events WHERE event_type = 'purchase' GROUP BY user_id),
steps AS (
  SELECT c_custkey AS k, c_nationkey, n_name, COALESCE(n_orders, 0) AS n_orders,
         COALESCE(extra, CAST(0 AS {_D})) AS extra,
         CAST(1 + (c_custkey * 7919 + 13) % 71 AS INTEGER) AS tenure,
         CAST((c_custkey * 104729 + 7) % 101 AS INTEGER) AS a,
         CAST((c_custkey * 15485863 + 3) % 97 AS INTEGER) AS b,
         CAST((c_custkey * 32452843 + 11) % 89 AS INTEGER) AS c,
         CAST((c_custkey * 49979687 + 5) % 83 AS INTEGER) AS d,
         CAST((c_custkey * 67867967 + 1) % 79 AS INTEGER) AS f,
         CAST(FLOOR(c_acctbal) AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(3,2)) AS mc,
         CAST(FLOOR(COALESCE(returned, CAST(0 AS {_D})) / 100) AS DECIMAL(16,0))
           * CAST(0.01 AS DECIMAL(3,2)) AS rf
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN history ON c_custkey = o_custkey LEFT JOIN bought ON c_custkey = user_id),
flags AS (
  SELECT *, b % 10 <> 0 AS phone, c % 5 <> 0 AS net, CAST(b * 0.5 AS {_D}) AS ld0,
         CASE WHEN a < 51 THEN 'Month-to-Month' WHEN a < 73 THEN 'One Year'
              ELSE 'Two Year' END AS contract
  FROM steps),
sums AS (
  SELECT *, GREATEST(mc, CAST(0 AS {_D})) * tenure AS tc,
         (CASE WHEN phone THEN ld0 ELSE CAST(0 AS {_D}) END) * tenure AS tld,
         CASE WHEN tenure <= 3 THEN 'Joined'
              WHEN d < (CASE contract WHEN 'Month-to-Month' THEN 45 WHEN 'One Year' THEN 10
                        ELSE 3 END) - CAST(FLOOR(tenure / 6.0) AS INTEGER) THEN 'Churned'
              ELSE 'Stayed' END AS status
  FROM flags),
accounts AS (
  SELECT 'C' || LPAD(CAST(k AS VARCHAR), 9, '0') AS Customer_ID,
         CASE WHEN f % 2 = 0 THEN 'Male' ELSE 'Female' END AS Gender,
         19 + f % 62 AS Age, {_yn('d % 2 = 0')} AS Married, a % 4 AS Number_of_Dependents,
         n_name AS City, CAST(90001 + c_nationkey AS INTEGER) AS Zip_Code,
         CAST(32.0 + 0.25 * c_nationkey AS DOUBLE) AS Latitude,
         CAST(-114.0 - 0.25 * c_nationkey AS DOUBLE) AS Longitude,
         CAST(n_orders % 12 AS INTEGER) AS Number_of_Referrals, tenure AS Tenure_in_Months,
         CASE f % 11 WHEN 0 THEN 'Offer A' WHEN 1 THEN 'Offer B' WHEN 2 THEN 'Offer C'
              WHEN 3 THEN 'Offer D' WHEN 4 THEN 'Offer E' END AS Offer,
         {_yn('phone')} AS Phone_Service,
         CAST(CASE WHEN phone THEN ld0 END AS DOUBLE) AS Avg_Monthly_Long_Distance_Charges,
         CASE WHEN phone THEN {_yn('a % 2 = 0')} END AS Multiple_Lines,
         {_yn('net')} AS Internet_Service,
         CASE WHEN net THEN CASE b % 3 WHEN 0 THEN 'Cable' WHEN 1 THEN 'DSL'
              ELSE 'Fiber Optic' END END AS Internet_Type,
         CAST(CASE WHEN net THEN 2 + d END AS DOUBLE) AS Avg_Monthly_GB_Download,
         {_net('a % 3 = 0')} AS Online_Security, {_net('b % 2 = 0')} AS Online_Backup,
         {_net('c % 2 = 0')} AS Device_Protection_Plan,
         {_net('d % 3 = 0')} AS Premium_Tech_Support, {_net('f % 2 = 1')} AS Streaming_TV,
         {_net('f % 5 < 2')} AS Streaming_Movies, {_net('f % 7 < 3')} AS Streaming_Music,
         {_net('d % 5 <> 0')} AS Unlimited_Data, contract AS Contract,
         {_yn('c % 3 <> 0')} AS Paperless_Billing,
         CASE WHEN d % 9 < 5 THEN 'Bank Withdrawal' WHEN d % 9 < 8 THEN 'Credit Card'
              ELSE 'Mailed Check' END AS Payment_Method,
         CAST(mc AS DOUBLE) AS Monthly_Charge, CAST(tc AS DOUBLE) AS Total_Charges,
         CAST(rf AS DOUBLE) AS Total_Refunds, CAST(extra AS DOUBLE) AS Total_Extra_Data_Charges,
         CAST(tld AS DOUBLE) AS Total_Long_Distance_Charges,
         CAST(tc + tld + extra - rf AS DOUBLE) AS Total_Revenue, status AS Customer_Status,
         CASE WHEN status = 'Churned' THEN CASE f % 5 WHEN 0 THEN 'Attitude'
              WHEN 1 THEN 'Competitor' WHEN 2 THEN 'Dissatisfaction' WHEN 3 THEN 'Other'
              ELSE 'Price' END END AS Churn_Category,
         CASE WHEN status = 'Churned' THEN 'Reason ' || CAST(f % 20 AS VARCHAR) END AS Churn_Reason
  FROM sums)"""

# The damaged text extract; the missing-value words are already NULL here.
_DAMAGE = {
    "Age": "CASE WHEN key % 41 = 0 THEN '4x' ELSE CAST(Age AS VARCHAR) END",
    "Married": "CASE WHEN key % 47 <> 0 THEN Married END",
    "Contract": "CASE WHEN key % 43 = 0 THEN 'Monthly' ELSE Contract END",
    "Offer": "CASE WHEN key % 53 <> 0 THEN Offer END",
    "Tenure_in_Months": "CASE WHEN key % 61 = 0 THEN '0' ELSE CAST(Tenure_in_Months AS VARCHAR) END",
    "Online_Security": "CASE WHEN key % 67 <> 0 THEN Online_Security END",
    "Payment_Method": "CASE WHEN key % 37 = 0 THEN 'Cash ' ELSE Payment_Method END",
    "Churn_Category": "CASE WHEN key % 71 = 0 THEN 'Weather' ELSE Churn_Category END",
    "Total_Charges": "CASE WHEN key % 73 = 0 THEN '-5.00' ELSE CAST(Total_Charges AS VARCHAR) END",
}
_RAW_COLUMNS = ", ".join(
    f"{_DAMAGE.get(c, f'CAST({c} AS VARCHAR)')} AS {c}" for c in C.COLUMNS)
_NUMBER = {"int": "INTEGER", "double": "DOUBLE"}
_TYPED_COLUMNS = ", ".join(
    c if C.FIELD[c].kind == "text" else f"TRY_CAST({c} AS {_NUMBER[C.FIELD[c].kind]}) AS {c}"
    for c in C.COLUMNS)
RAW = f"""
keyed AS (SELECT *, CAST(SUBSTRING(Customer_ID, 2) AS BIGINT) AS key FROM accounts),
copied AS (SELECT * FROM keyed UNION ALL SELECT * FROM keyed WHERE key % 59 = 0),
raw AS (SELECT {_RAW_COLUMNS} FROM copied),
typed AS (SELECT {_TYPED_COLUMNS} FROM raw)"""


def _filled(c: str) -> str:
    if c == "Avg_Monthly_Long_Distance_Charges":
        return "CASE WHEN Phone_Service = 'No' THEN 0.0::DOUBLE ELSE {0} END".format(c)
    if c == "Multiple_Lines":
        return "CASE WHEN Phone_Service = 'No' THEN 'No' ELSE {0} END".format(c)
    if c == "Avg_Monthly_GB_Download":
        return "CASE WHEN Internet_Service = 'No' THEN 0.0::DOUBLE ELSE {0} END".format(c)
    if c == "Internet_Type":
        return "CASE WHEN Internet_Service = 'No' THEN 'No Internet' ELSE {0} END".format(c)
    if c in C.INTERNET_ADD_ONS:
        return "CASE WHEN Internet_Service = 'No' THEN 'No' ELSE {0} END".format(c)
    if c == "Offer":
        return "COALESCE(Offer, 'No Offer')"
    if c in ("Churn_Category", "Churn_Reason"):
        return f"COALESCE({c}, 'No Churn')"
    return c


def _coded(c: str) -> str:
    if c == "Gender":
        return "CASE Gender WHEN 'Male' THEN 1 WHEN 'Female' THEN 0 END"
    if c in C.YES_NO_FIELDS:
        return f"CASE {c} WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END"
    return c


def feature_ctes(source: str) -> str:
    """repaired, encoded, derived and features over ``source``."""
    repaired = ", ".join(f"{_filled(c)} AS {c}" for c in C.COLUMNS)
    encoded = ", ".join(f"{_coded(c)} AS {c}" for c in C.COLUMNS)
    dummies = ", ".join(f"CAST({f} = '{level}' AS INTEGER) AS {name}"
                        for name, (f, level) in C.DUMMIES.items())
    return f"""
repaired AS (SELECT {repaired} FROM {source}),
encoded AS (SELECT {encoded} FROM repaired),
derived AS (
  SELECT *, {' + '.join(C.SERVICES)} AS Total_Services,
         {' + '.join(C.PREMIUM_ADD_ONS)} AS Premium_Services,
         {' + '.join(C.STREAMING_ADD_ONS)} AS Streaming_Services,
         CAST(Phone_Service = 1 AND Internet_Service = 1 AS INTEGER) AS Has_Phone_And_Internet,
         Tenure_in_Months / 12.0::DOUBLE AS Tenure_Years,
         CASE WHEN Tenure_in_Months <> 0 THEN Number_of_Referrals::DOUBLE
              / (Tenure_in_Months / 12.0::DOUBLE) END AS Referrals_per_Tenure_Year,
         CASE WHEN Monthly_Charge > 0 AND Avg_Monthly_Long_Distance_Charges + Monthly_Charge > 0
              THEN Avg_Monthly_Long_Distance_Charges
                   / (Avg_Monthly_Long_Distance_Charges + Monthly_Charge)
              ELSE 0.0::DOUBLE END AS Long_Distance_Dependency,
         CAST(Tenure_in_Months <= 6 AS INTEGER) AS Is_New_Customer,
         CAST(Age >= 60 AS INTEGER) AS Senior_Citizen
  FROM encoded),
wide AS (
  SELECT *, CASE WHEN Total_Services > 0 THEN Monthly_Charge / Total_Services::DOUBLE
                 ELSE 0.0::DOUBLE END AS Monthly_Charge_per_Service, {dummies}
  FROM derived),
features AS (SELECT {', '.join(C.FEATURE_COLUMNS)} FROM wide)"""


def _level(x: str, f: str) -> str:
    return (f"CASE WHEN {x} <= {f}_lo THEN 'Low' WHEN {x} <= {f}_hi THEN 'Mid' ELSE 'High' END")


def _word(level: str, words: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in words.items())
    return f"CASE {level} {cases} END"


def _segment(tenure_level: str, spend_level: str) -> str:
    return (f"{_word(tenure_level, C.TENURE_WORDS)} || ' ' || "
            f"{_word(spend_level, C.SPEND_WORDS)} || ' Customers'")


_T, _M, _S = C.SEGMENT_FEATURES
_CUTS = ", ".join(
    f"quantile_cont({f}, 1 / 3.0::DOUBLE) AS {f}_lo, quantile_cont({f}, 2 / 3.0::DOUBLE) AS {f}_hi"
    for f in C.SEGMENT_FEATURES)
_NUMBER_OF = "CASE {0} WHEN 'Low' THEN 0 WHEN 'Mid' THEN 1 ELSE 2 END"
RULES = f"""
base AS (
  SELECT Customer_ID, Customer_Status, {_T}, {_M}, {_S}, Total_Revenue AS Predicted_CLV,
         ROUND(0.6::DOUBLE * (CASE WHEN Contract = 'Month-to-Month' THEN 1.0::DOUBLE
                              ELSE 0.0::DOUBLE END)
               + 0.3::DOUBLE / (1.0::DOUBLE + Tenure_Years)
               + 0.1::DOUBLE * (1.0::DOUBLE - Premium_Services / 4.0::DOUBLE), 6)
           AS Churn_Probability
  FROM features),
medians AS (SELECT quantile_cont(Churn_Probability, 0.5) AS p50,
                   quantile_cont(Predicted_CLV, 0.5) AS v50 FROM base),
cuts AS (SELECT {_CUTS} FROM base),
levels AS (
  SELECT base.*, {_level(_T, _T)} AS tenure_level, {_level(_M, _M)} AS spend_level,
         {_level(_S, _S)} AS services_level FROM base CROSS JOIN cuts),
named AS (
  SELECT *, {_NUMBER_OF.format('tenure_level')} * 3 + {_NUMBER_OF.format('spend_level')} AS Cluster,
         {_segment('tenure_level', 'spend_level')} AS Segment FROM levels),
matrix AS (
  SELECT *, Churn_Probability >= p50 AS hr, Predicted_CLV >= v50 AS hv,
         CASE WHEN Churn_Probability >= p50 AND Predicted_CLV >= v50 THEN 'Immediate Save'
              WHEN Churn_Probability >= p50 THEN 'Nurture'
              WHEN Predicted_CLV >= v50 THEN 'Monitor' ELSE 'Low Priority' END AS Priority_Label
  FROM named CROSS JOIN medians),
ranked AS (
  SELECT Customer_ID, Churn_Probability, Predicted_CLV, Priority_Label, Segment,
         ROW_NUMBER() OVER (ORDER BY CASE Priority_Label WHEN 'Immediate Save' THEN 1
           WHEN 'Nurture' THEN 2 WHEN 'Monitor' THEN 3 ELSE 4 END,
           Churn_Probability DESC, Customer_ID) AS rank
  FROM matrix)"""


def profile_ctes(key: str) -> str:
    """profiles: one named row per rule cluster ``key`` of ``named``."""
    z = {f: f"{f}_centroid" for f in C.SEGMENT_FEATURES}
    means = ", ".join(
        f"CAST(SUM(CAST({f} AS {_D})) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS {z[f]}"
        for f in C.SEGMENT_FEATURES)
    return f"""
grouped AS (SELECT {key} AS cluster, COUNT(*) AS customers, {means} FROM named GROUP BY 1),
leveled AS (
  SELECT grouped.*, CAST(customers AS DOUBLE) / CAST(SUM(customers) OVER () AS DOUBLE) AS share,
         {_level(z[_T], _T)} AS tenure_level, {_level(z[_M], _M)} AS spend_level,
         {_level(z[_S], _S)} AS services_level FROM grouped CROSS JOIN cuts),
titled AS (SELECT *, {_segment('tenure_level', 'spend_level')} AS title FROM leveled),
profiles AS (
  SELECT cluster, CASE WHEN COUNT(*) OVER (PARTITION BY title) > 1
           THEN title || ' (' || {_word('services_level', C.SERVICE_WORDS)} || ' Services)'
           ELSE title END AS segment,
         customers, ROUND(share, 6) AS share,
         {', '.join(f'ROUND({z[f]}, 6) AS {z[f]}' for f in C.SEGMENT_FEATURES)},
         tenure_level, spend_level, services_level FROM titled)"""


FEATURES = feature_ctes("accounts")
RAW_FEATURES = feature_ctes("typed")
PREDICTED = """
predicted AS (
  SELECT Customer_ID, Churn_Probability, CAST(Customer_Status = 'Churned' AS INTEGER) AS label,
         CAST(Churn_Probability >= 0.5 AS INTEGER) AS prediction
  FROM base WHERE Customer_Status IN ('Stayed', 'Churned'))"""


def _with(parts: list[str], body: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + body


def a(body: str) -> str:
    return _with([ACCOUNTS], body)


def r(body: str) -> str:
    return _with([ACCOUNTS, RAW], body)


def rf(body: str) -> str:
    return _with([ACCOUNTS, RAW, RAW_FEATURES], body)


def f(body: str) -> str:
    return _with([ACCOUNTS, FEATURES], body)


def m(body: str, *more: str) -> str:
    return _with([ACCOUNTS, FEATURES, RULES, *more], body)


def _union(rows: list[str]) -> str:
    return "\nUNION ALL ".join(rows)


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# --- validation twins -------------------------------------------------------

def _bad_number(c: str) -> str:
    kind = _NUMBER[C.FIELD[c].kind]
    return f"{c} IS NOT NULL AND TRY_CAST({c} AS {kind}) IS NULL"


def _bad_word(c: str, col: str | None = None, vocabulary=None) -> str:
    col = col or c
    return f"({col}) IS NOT NULL AND ({col}) NOT IN {_in(vocabulary or C.FIELD[c].vocabulary)}"


def _check_row(position: int, check: str, column: str, condition: str) -> str:
    return (f"SELECT {position} AS position, '{check}' AS \"check\", '{column}' AS \"column\", "
            f"COUNT(*) FILTER (WHERE {condition}) AS violations FROM raw")


def _report() -> str:
    rows = ["SELECT 1 AS position, 'row_count' AS \"check\", '*' AS \"column\", "
            "CAST(0 AS BIGINT) AS violations",
            "SELECT 4, 'duplicate_id', 'Customer_ID', COUNT(*) - COUNT(DISTINCT Customer_ID) FROM raw"]
    rows += [_check_row(5, "non_numeric", c, _bad_number(c)) for c in C.NUMERIC]
    rows += [_check_row(6, "unexpected_blank", c, f"{c} IS NULL")
             for c in C.COLUMNS if c not in C.BLANKABLE]
    rows += [_check_row(8 if c == "Churn_Category" else 7, "vocabulary", c, _bad_word(c))
             for c in C.CATEGORY_FIELDS]
    rows += [_check_row(9, "unrepaired_blank", c, f"({_text_filled(c)}) IS NULL")
             for c in C.BLANKABLE if c not in C.OUTCOMES]
    rows += [_check_row(10, "yes_no", c, _bad_word(c, _text_filled(c), C.YES_NO))
             for c in C.YES_NO_FIELDS]
    return _union(rows)


def _text_filled(c: str) -> str:
    return _filled(c).replace("0.0::DOUBLE", "'0.0'")


def _reasons() -> str:
    """The text extract laid over typed columns, then every reason in order."""
    parts = []
    for c in C.SCORE_INPUTS:
        blank = (f"({_filled(c)}) IS NULL THEN '{c}: blank that cannot be repaired'"
                 if C.FIELD[c].may_be_blank else f"{c} IS NULL THEN '{c}: missing'")
        cases = [f"WHEN {blank}"]
        if C.FIELD[c].vocabulary:
            cases.append(f"WHEN {_bad_word(c)} THEN '{c}: unknown value'")
        if c in C.SCORE_BOUNDS:
            low, high = C.SCORE_BOUNDS[c]
            outside = f"{c} < {low}" + (f" OR {c} > {high}" if high is not None else "")
            cases.append(f"WHEN {outside} THEN '{c}: out of range'")
        if c == "Tenure_in_Months":
            cases.append(f"WHEN {c} = 0 THEN '{c}: zero, no referral rate'")
        parts.append(f"CASE {' '.join(cases)} END")
    return ", ".join(parts)


def _split(source: str, columns: str, key: str, stratum: str | None) -> str:
    """Naive exact split: rank everything, deal the test rows out."""
    cls = stratum or "0"
    return f"""
WITH sized AS (
  SELECT {cls} AS cls, COUNT(*) AS n FROM {source} GROUP BY 1),
total AS (SELECT *, CAST(CEIL(0.2::DOUBLE * SUM(n) OVER ()) AS BIGINT) AS t,
                 CAST(SUM(n) OVER () AS BIGINT) AS n_all FROM sized),
floors AS (SELECT cls, n, t, n_all, (t * n) // n_all AS lo, (t * n) % n_all AS rest FROM total),
dealt AS (
  SELECT cls, lo + CASE WHEN ROW_NUMBER() OVER (ORDER BY rest DESC, cls)
                          <= t - CAST(SUM(lo) OVER () AS BIGINT) THEN 1 ELSE 0 END AS n_test
  FROM floors),
placed AS (
  SELECT {columns}, {cls} AS cls, ROW_NUMBER() OVER (
           PARTITION BY {cls} ORDER BY md5('42|' || CAST({key} AS VARCHAR))) AS place
  FROM {source})
SELECT {columns}, place <= n_test AS is_test FROM placed JOIN dealt USING (cls)"""


def _auc(source: str, score: str, label: str) -> str:
    return f"""
SELECT ROUND(CAST(SUM(CAST(pos * (2 * before + neg) AS DECIMAL(38,0))) AS DOUBLE)
             / (2.0::DOUBLE * CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)), 9) AS roc_auc
FROM (SELECT pos, neg, COALESCE(SUM(neg) OVER (ORDER BY score
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM (SELECT {score} AS score, COUNT(*) FILTER (WHERE {label} = 1) AS pos,
                   COUNT(*) FILTER (WHERE {label} = 0) AS neg FROM {source} GROUP BY 1))"""


_STATUSES = [s.lower() for s in C.STATUSES]
_LABEL_COLUMNS = {name: name.lower().replace(" ", "_") for name in C.PRIORITY_LABELS}
_RISK_SUM = ("COALESCE(CAST(SUM(CASE WHEN Priority_Label IN ('Immediate Save', 'Nurture') "
             "THEN CAST(Predicted_CLV AS DECIMAL(28,6)) END) AS DOUBLE), 0.0::DOUBLE)")
_KPIS = f"""
kpi_counts AS (
  SELECT COUNT(*) AS base,
         {', '.join(f"COUNT(*) FILTER (WHERE Customer_Status = '{s}') AS {s.lower()}" for s in C.STATUSES)},
         {', '.join(f"COUNT(*) FILTER (WHERE Priority_Label = '{n}') AS {c}" for n, c in _LABEL_COLUMNS.items())},
         {_RISK_SUM} AS value_at_risk FROM matrix),
kpis AS (
  SELECT *, stayed + churned AS resolved, churned::DOUBLE / (stayed + churned)::DOUBLE AS churn_rate,
         immediate_save + nurture AS at_risk,
         {', '.join(f"{c}::DOUBLE / base::DOUBLE AS {c}_share" for c in _LABEL_COLUMNS.values())}
  FROM kpi_counts)"""
_MATRIX = "Customer_ID, Churn_Probability, Predicted_CLV, Priority_Label, Segment"
_YEARS = "GREATEST(Tenure_in_Months / 12.0::DOUBLE, 1e-9::DOUBLE)"
_LABELS_LIST = ", ".join(f"({i}, '{n}')" for i, n in enumerate(C.PRIORITY_LABELS, start=1))


def _finite(source: str, columns) -> str:
    return _union([
        f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL OR isnan({c}::DOUBLE) "
        f"OR isinf({c}::DOUBLE)) AS not_finite FROM {source}" for c in columns])


def _quantile_row(table: str, column: str) -> str:
    return (f"SELECT '{column}' AS \"column\", COUNT({column}) AS row_count, "
            f"ROUND(quantile_cont({column}, 1 / 3.0::DOUBLE), 6) AS lower_third, "
            f"ROUND(quantile_cont({column}, 0.5), 6) AS median, "
            f"ROUND(quantile_cont({column}, 2 / 3.0::DOUBLE), 6) AS upper_third FROM {table}")


def _z(c: str, source: str) -> str:
    return (f"ROUND(({c} - (SELECT AVG({c}) FROM {source})) / "
            f"(SELECT STDDEV_POP({c}) FROM {source}), 6) AS {c}_z")


def _standard(source: str, key: str, columns) -> str:
    return f"SELECT {key}, {', '.join(_z(c, source) for c in columns)} FROM {source}"


def _silhouette() -> str:
    """From the statistics of each cluster: mean squared distances need no pairs."""
    cs = C.SEGMENT_FEATURES
    norm = " + ".join(f"{c} * {c}" for c in cs)
    cross = " + ".join(f"p.{c} * g.m_{c}" for c in cs)
    return f"""
SELECT ROUND(AVG(CASE WHEN own_n > 1 AND GREATEST(a, b) > 0 THEN (b - a) / GREATEST(a, b)
                 ELSE 0.0::DOUBLE END), 6) AS silhouette
FROM (SELECT p.Customer_ID, MAX(CASE WHEN g.Cluster = p.Cluster THEN n END) AS own_n,
             MAX(CASE WHEN g.Cluster = p.Cluster AND n > 1
                 THEN GREATEST(p.norm - 2 * ({cross}) + square, 0) * n / (n - 1) END) AS a,
             MIN(CASE WHEN g.Cluster <> p.Cluster
                 THEN GREATEST(p.norm - 2 * ({cross}) + square, 0) END) AS b
      FROM (SELECT *, {norm} AS norm FROM picked) p
      CROSS JOIN (SELECT Cluster, COUNT(*)::DOUBLE AS n, AVG({norm}) AS square,
                         {', '.join(f'AVG({c}) AS m_{c}' for c in cs)} FROM picked GROUP BY 1) g
      GROUP BY 1)"""


def _euclidean_silhouette() -> str:
    """Over pairs of different points, with the rows they stand for as weights."""
    cs = C.SEGMENT_FEATURES
    apart = " + ".join(f"(p.{c} - q.{c}) * (p.{c} - q.{c})" for c in cs)
    return f"""
SELECT ROUND(SUM(w * CASE WHEN own_n > 1 AND GREATEST(a, b) > 0 THEN (b - a) / GREATEST(a, b)
                     ELSE 0.0::DOUBLE END) / SUM(w), 6) AS silhouette
FROM (SELECT id, ANY_VALUE(w) AS w, MAX(CASE WHEN mine THEN n END) AS own_n,
             MAX(CASE WHEN mine AND n > 1 THEN total / (n - 1) END) AS a,
             MIN(CASE WHEN NOT mine THEN total / n END) AS b
      FROM (SELECT p.id, ANY_VALUE(p.w) AS w, p.Cluster = q.Cluster AS mine, q.Cluster AS other,
                   SUM(q.w * SQRT({apart})) AS total, SUM(q.w)::DOUBLE AS n
            FROM points p CROSS JOIN points q GROUP BY p.id, p.Cluster, q.Cluster)
      GROUP BY id)"""


def _drift_rows() -> str:
    """The changes of the query, and the values they concern, one by one."""
    places = {c: i for i, c in enumerate(C.COLUMNS)}
    churn = {c: i for i, c in enumerate(C.CHURN_PREDICTORS)}
    value = {c: i for i, c in enumerate(C.VALUE_PREDICTORS)}
    n = len(C.COLUMNS)
    raw_rows = [
        ("accounts", places["Offer"], "Offer", "missing", None, "0 * COUNT(*)", "0"),
        ("accounts", n - 1, "Loyalty_Tier", "unexpected", "string", "COUNT(Contract)", "0"),
        ("accounts", n, "Is_Ok", "unexpected", "boolean", "COUNT(Age)", "0"),
        ("accounts", places["Monthly_Charge"], "Monthly_Charge", "moved", "column 0", "COUNT(Monthly_Charge)", "0"),
    ]
    seniors = "COUNT(*) FILTER (WHERE Senior_Citizen = 1)"
    built_rows = [
        ("churn model", churn["Offer_Offer_A"], "Offer_Offer_A", "missing", None, "0 * COUNT(*)", "0"),
        ("churn model", churn["Age"], "Age", "not a number", "string", "COUNT(Age)", seniors),
        ("churn model", churn["Total_Services"], "Total_Services", "moved", "column 0", "COUNT(Total_Services)", "0"),
        ("value model", value["Offer_Offer_A"], "Offer_Offer_A", "missing", None, "0 * COUNT(*)", "0"),
        ("value model", value["Age"], "Age", "not a number", "string", "COUNT(Age)", seniors),
    ]

    def row(entry, table):
        reader, place, column, drift, found, values, unusable = entry
        text = "CAST(NULL AS VARCHAR)" if found is None else f"'{found}'"
        return (f"SELECT '{reader}' AS reader, CAST({place} AS INTEGER) AS position, '{column}' AS \"column\", "
                f"'{drift}' AS drift, {text} AS found, CAST({values} AS BIGINT) AS \"values\", "
                f"CAST({unusable} AS BIGINT) AS unusable FROM {table}")
    return _union([row(e, "raw") for e in raw_rows] + [row(e, "features") for e in built_rows])


def _gate_rows(table: str, name: str) -> list[str]:
    blanks = " + ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL)" for c in C.FEATURE_COLUMNS)
    counts = {"row_count": "ABS(COUNT(*) - (SELECT COUNT(*) FROM customer))", "blanks": blanks}
    counts |= {f"{c}_not_finite": f"COUNT(*) FILTER (WHERE {c} IS NULL OR isnan({c}::DOUBLE) OR isinf({c}::DOUBLE))"
               for c in C.SEGMENT_FEATURES}
    return [f"SELECT '{name}' AS artifact, '{gate}' AS gate, CAST({n} AS BIGINT) AS violations, "
            f"{n} = 0 AS passed FROM {table}" for gate, n in counts.items()]


_POINTS = f"""
points AS (SELECT Cluster, {', '.join(C.SEGMENT_FEATURES)}, COUNT(*) AS w, ROW_NUMBER() OVER () AS id
           FROM picked GROUP BY Cluster, {', '.join(C.SEGMENT_FEATURES)})"""
_PICKED = f"""
picked AS (SELECT Customer_ID, Cluster, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in C.SEGMENT_FEATURES)}
           FROM named)"""
_SEGMENT_PROFILES = profile_ctes("Segment")
_LABELLED = """(SELECT Customer_ID, CAST(Customer_Status = 'Churned' AS INTEGER) AS label
  FROM accounts WHERE Customer_Status IN ('Stayed', 'Churned'))"""


def _nested(outer_with: list[str], statement: str) -> str:
    """Prepend CTEs to a statement that starts with its own WITH."""
    return "WITH " + ",".join(outer_with) + "," + statement.strip()[len("WITH"):]


def _no_violation(table: str) -> str:
    return f"SELECT COUNT(*) AS row_count, CAST(0 AS BIGINT) AS violations FROM {table}"


ORACLES = {
    # scans and validation
    "q_scan_accounts": r("SELECT * FROM typed"),
    "q_csv_round_trip": r("SELECT * FROM typed"),
    "q_stage_round_trip": f("SELECT * FROM features"),
    "q_validate_report": r(_report()),
    "q_duplicate_ids": r("SELECT Customer_ID, COUNT(*) - 1 AS extra_copies FROM raw "
                         "GROUP BY 1 HAVING COUNT(*) > 1"),
    "q_duplicate_count": r("SELECT COUNT(*) AS row_count, COUNT(DISTINCT Customer_ID) AS distinct_keys, "
                           "COUNT(*) - COUNT(DISTINCT Customer_ID) AS extra_copies FROM raw"),
    "q_numeric_coercion": r(_union([
        f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {_bad_number(c)}) AS violations FROM raw"
        for c in C.NUMERIC])),
    "q_blank_profile": r(_union([
        f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL) AS blanks FROM raw"
        for c in C.COLUMNS])),
    "q_vocab_check": r(_union([
        f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {_bad_word(c)}) AS violations FROM raw"
        for c in C.CATEGORY_FIELDS])),
    "q_vocab_violations": r(_union([
        f"SELECT '{c}' AS \"column\", {c} AS value, COUNT(*) AS row_count FROM raw "
        f"WHERE {_bad_word(c)} GROUP BY 2" for c in C.CATEGORY_FIELDS])),
    "q_status_counts": a("SELECT Customer_Status, COUNT(*) AS row_count FROM accounts GROUP BY 1"),
    "q_contract_drift": _with([ACCOUNTS, RAW, FEATURES], _drift_rows()),
    "q_class_presence": a("""
SELECT CAST(c AS VARCHAR) AS class, TRUE AS expected,
       (SELECT COUNT(*) FROM accounts WHERE Customer_Status = s) AS members,
       (SELECT COUNT(*) FROM accounts WHERE Customer_Status = s) > 0 AS present
FROM (VALUES (0, 'Stayed'), (1, 'Churned')) AS v(c, s)"""),
    "q_artifact_gates": _with([ACCOUNTS, RAW, FEATURES, re.sub(
        r"\b(repaired|encoded|derived|wide|features)\b", r"raw_\1", RAW_FEATURES)], _union(
        _gate_rows("features", "features") + _gate_rows("raw_features", "raw features"))),
    "q_artifact_refresh": a(_union([
        f"SELECT {v} AS version, {k} AS reading, {c} AS value, COUNT(*) AS row_count FROM accounts GROUP BY 3"
        for v, c in ((1, "Customer_Status"), (2, "Contract")) for k in (1, 2)])),
    "q_feature_nulls": rf(_union([
        f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL) AS blanks FROM features"
        for c in C.FEATURE_COLUMNS])),
    "q_target_check": rf(_finite("features", ["Total_Revenue", *C.SEGMENT_FEATURES,
                                              "Referrals_per_Tenure_Year"])),
    "q_score_range_check": m("""
SELECT COUNT(*) AS row_count,
       COUNT(*) FILTER (WHERE Churn_Probability IS NULL OR isnan(Churn_Probability)
                        OR isinf(Churn_Probability)) AS probability_not_finite,
       COUNT(*) FILTER (WHERE NOT Churn_Probability BETWEEN 0 AND 1) AS probability_out_of_range,
       COUNT(*) FILTER (WHERE Predicted_CLV IS NULL OR isnan(Predicted_CLV)
                        OR isinf(Predicted_CLV)) AS value_not_finite FROM base"""),
    "q_assignment_contract": m("""
SELECT COUNT(*) AS row_count, COUNT(*) FILTER (WHERE Segment IS NULL) AS null_names,
       COUNT(*) FILTER (WHERE Segment NOT IN (SELECT segment FROM profiles)) AS unknown_names,
       (SELECT COUNT(DISTINCT segment) FROM profiles
        WHERE segment NOT IN (SELECT Segment FROM named)) AS unused_names,
       COUNT(*) - COUNT(DISTINCT Customer_ID) AS extra_copies FROM named""", _SEGMENT_PROFILES),
    "q_label_contract": m(f"""
SELECT COUNT(*) AS row_count, COUNT(*) FILTER (WHERE Priority_Label IS NULL) AS null_labels,
       COUNT(*) FILTER (WHERE Priority_Label NOT IN {_in(C.PRIORITY_LABELS)}) AS unknown_labels,
       4 - COUNT(DISTINCT Priority_Label) AS unused_labels,
       COUNT(*) - COUNT(DISTINCT Customer_ID) AS extra_copies FROM matrix"""),
    # projections and derived features
    "q_repair_blanks": f("SELECT * FROM repaired"),
    "q_encode_binary": f(f"SELECT Customer_ID, Gender, {', '.join(C.YES_NO_FIELDS)} FROM encoded"),
    "q_one_hot": f(f"SELECT Customer_ID, {', '.join(C.DUMMIES)} FROM features"),
    "q_derived_features": f(f"SELECT Customer_ID, {', '.join(C.DERIVED_COLUMNS)} FROM features"),
    "q_features": f("SELECT * FROM features"),
    "q_complete_features": rf(
        f"SELECT Customer_ID, {', '.join(C.DERIVED_COLUMNS)} FROM features WHERE "
        + " AND ".join(f"{c} IS NOT NULL" for c in C.FEATURE_COLUMNS)),
    "q_churn_predictors": f(f"SELECT Customer_ID, {', '.join(C.CHURN_PREDICTORS)} FROM features"),
    "q_clv_predictors": f(f"SELECT Customer_ID, {', '.join(C.VALUE_PREDICTORS)} FROM features"),
    "q_training_population": f(
        "SELECT Customer_ID, CAST(Customer_Status = 'Churned' AS DOUBLE) AS label, "
        "Tenure_in_Months, Total_Services FROM features "
        "WHERE Customer_Status IN ('Stayed', 'Churned')"),
    "q_clv_training": f("SELECT Customer_ID, Total_Revenue AS label, Tenure_in_Months, "
                        "Monthly_Charge FROM features"),
    "q_score_input": a(
        "SELECT Customer_ID, " + ", ".join(
            "CAST(NULL AS VARCHAR) AS Unlimited_Data" if c == "Unlimited_Data" else c
            for c in C.SCORE_INPUTS) + " FROM accounts"),
    "q_rejected_records": r(
        f"SELECT * FROM (SELECT Customer_ID, concat_ws('; ', {_reasons()}) AS reasons FROM typed) "
        "WHERE reasons <> ''"),
    # statistics
    "q_median_thresholds": m("""
SELECT ANY_VALUE(p50) AS median_probability, ANY_VALUE(v50) AS median_value,
       COUNT(*) FILTER (WHERE hr) AS high_risk, COUNT(*) FILTER (WHERE hv) AS high_value FROM matrix"""),
    "q_terciles": m(_union([
        f"SELECT '{c}' AS feature, ROUND(quantile_cont({c}, 1 / 3.0::DOUBLE)::DOUBLE, 6) AS lower_third, "
        f"ROUND(quantile_cont({c}, 2 / 3.0::DOUBLE)::DOUBLE, 6) AS upper_third, "
        f"COUNT({c}) AS row_count FROM base"
        for c in C.SEGMENT_FEATURES])),
    "q_tercile_levels": m(f"SELECT Customer_ID, tenure_level AS {_T}_level, spend_level AS {_M}_level, "
                          f"services_level AS {_S}_level FROM levels"),
    "q_fixed_sample": a(f"""
SELECT Customer_ID, Tenure_in_Months FROM (
  SELECT *, ROW_NUMBER() OVER (ORDER BY md5('42|' || Customer_ID)) AS place FROM accounts)
WHERE place <= {SAMPLE_ROWS}"""),
    "q_stratified_split": _nested([ACCOUNTS, f"labelled AS {_LABELLED}"],
                                  _split("labelled", "Customer_ID, label", "Customer_ID", "label")),
    "q_plain_split": _nested([ACCOUNTS], _split("accounts", "Customer_ID", "Customer_ID", None)),
    "q_standardize": m(_standard("base", "Customer_ID", C.SEGMENT_FEATURES)),
    "q_class_weights": a(f"""
SELECT label, COUNT(*) AS members,
       CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / CAST(COUNT(*) OVER () * COUNT(*) AS DOUBLE) AS weight
FROM {_LABELLED} GROUP BY label"""),
    "q_classification_metrics": m("""
SELECT 'rule' AS model, ROUND((tp + tn)::DOUBLE / n, 6) AS accuracy,
       ROUND(COALESCE(tp::DOUBLE / NULLIF(tp + fp, 0), 0), 6) AS precision,
       ROUND(COALESCE(tp::DOUBLE / NULLIF(tp + fn, 0), 0), 6) AS recall,
       ROUND(COALESCE((2 * tp)::DOUBLE / NULLIF(2 * tp + fp + fn, 0), 0), 6) AS f1
FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
             COUNT(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
             COUNT(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
             COUNT(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn FROM predicted)""", PREDICTED),
    "q_confusion_matrix": m("""
SELECT 'rule' AS model, actual, predicted, COUNT(label) AS count
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS cell(actual, predicted)
LEFT JOIN predicted p ON p.label = actual AND p.prediction = predicted GROUP BY 2, 3""", PREDICTED),
    "q_roc_auc": m(_auc("predicted", "Churn_Probability", "label"), PREDICTED),
    "q_regression_metrics": f("""
SELECT ROUND(SQRT(AVG(e * e)), 6) AS rmse, ROUND(AVG(ABS(e)), 6) AS mae,
       ROUND(1 - SUM(e * e) / SUM((y - mean_y) * (y - mean_y)), 6) AS r2
FROM (SELECT Total_Revenue AS y, Total_Revenue - Monthly_Charge * Tenure_in_Months AS e,
             AVG(Total_Revenue) OVER () AS mean_y FROM features)"""),
    "q_silhouette": m(_silhouette(), _PICKED),
    "q_silhouette_euclidean": m(_euclidean_silhouette(), _PICKED, _POINTS),
    # priority matrix and KPIs
    "q_priority_labels": m("SELECT Customer_ID, Churn_Probability, Predicted_CLV, Priority_Label "
                           "FROM matrix"),
    "q_attach_segments": m(f"SELECT {_MATRIX} FROM matrix"),
    "q_ranked_list": m("SELECT * FROM ranked"),
    "q_label_counts": m(f"""
SELECT position, l.Priority_Label, COUNT(Customer_ID) AS accounts,
       COUNT(Customer_ID)::DOUBLE / (SELECT COUNT(*) FROM matrix)::DOUBLE AS share
FROM (VALUES {_LABELS_LIST}) AS l(position, Priority_Label)
LEFT JOIN matrix USING (Priority_Label) GROUP BY 1, 2"""),
    "q_value_at_risk": m(f"""
SELECT COUNT(*) FILTER (WHERE Priority_Label IN ('Immediate Save', 'Nurture')) AS at_risk_accounts,
       {_RISK_SUM} AS value_at_risk FROM matrix"""),
    "q_immediate_save_by_segment": m("""
SELECT Segment, COUNT(*) AS customers,
       COUNT(*) FILTER (WHERE Priority_Label = 'Immediate Save') AS immediate_save
FROM matrix GROUP BY 1"""),
    "q_segment_overview": m(f"""
SELECT Segment, accounts, immediate_save, ROUND(total_predicted_clv, 6) AS total_predicted_clv,
       ROUND(at_risk_clv, 6) AS at_risk_clv, Tenure_in_Months_centroid, Monthly_Charge_centroid
FROM (SELECT Segment, COUNT(*) AS accounts,
             COUNT(*) FILTER (WHERE Priority_Label = 'Immediate Save') AS immediate_save,
             CAST(SUM(CAST(Predicted_CLV AS DECIMAL(28,6))) AS DOUBLE) AS total_predicted_clv,
             {_RISK_SUM} AS at_risk_clv FROM matrix GROUP BY 1) s
LEFT JOIN (SELECT segment AS pname, Tenure_in_Months_centroid, Monthly_Charge_centroid
           FROM profiles) p ON s.Segment = p.pname""", _SEGMENT_PROFILES),
    "q_segment_profiles_rule": m("SELECT * FROM profiles", _SEGMENT_PROFILES),
    "q_segment_profiles_collision": m("SELECT * FROM profiles",
                                      profile_ctes("tenure_level || '/' || services_level")),
    "q_kpis": m("SELECT * FROM kpis", _KPIS),
    "q_kpi_formatted": m("""
SELECT format('{:,}', base) AS total_customers,
       format('{:.1f}%', churn_rate * 100) AS resolved_churn_rate,
       format('{:,}', at_risk) AS predicted_at_risk,
       '$' || format('{:,}', CAST(round_even(value_at_risk, 0) AS BIGINT)) AS clv_at_risk
FROM kpis""", _KPIS),
    "q_business_summary": m(f"""
SELECT COUNT(*) AS total_customers,
       COUNT(*) FILTER (WHERE Priority_Label IN ('Immediate Save', 'Nurture')) AS predicted_churners,
       {', '.join(f"COUNT(*) FILTER (WHERE Priority_Label = '{n}') AS {c}" for n, c in _LABEL_COLUMNS.items())},
       {_RISK_SUM} AS clv_at_risk FROM matrix"""),
    "q_score_range": m("""
SELECT MIN(Churn_Probability) AS min_probability, MAX(Churn_Probability) AS max_probability,
       MIN(Predicted_CLV) AS min_value, MAX(Predicted_CLV) AS max_value FROM base"""),
    "q_target_stats": _nested(
        [ACCOUNTS, "drawn AS (" + _split("accounts", "Customer_ID, Total_Revenue", "Customer_ID", None) + ")"],
        "WITH x AS (SELECT 1) SELECT COUNT(*) AS row_count, ROUND(AVG(Total_Revenue), 6) AS mean, "
        "ROUND(STDDEV_SAMP(Total_Revenue), 6) AS std FROM drawn WHERE is_test"),
    "q_id_coverage": m("""
SELECT 'features only' AS side, COUNT(*) AS unmatched FROM accounts
WHERE Customer_ID NOT IN (SELECT Customer_ID FROM matrix)
UNION ALL
SELECT 'matrix only', COUNT(*) FROM matrix
WHERE Customer_ID NOT IN (SELECT Customer_ID FROM accounts)"""),
    # lookup
    "q_search_accounts": m(f"SELECT {_MATRIX} FROM matrix "
                           "WHERE contains(lower(Customer_ID), 'c0000001')"),
    "q_filter_queue": m(f"SELECT {_MATRIX} FROM matrix "
                        "WHERE Priority_Label IN ('Immediate Save', 'Nurture')"),
    "q_priority_queue": m("""
SELECT Customer_ID AS customer_id, Customer_Status AS status, Priority_Label AS priority,
       ROUND(Churn_Probability * 100, 6) AS churn_pct, ROUND(Predicted_CLV, 6) AS predicted_clv,
       Segment AS segment, Tenure_in_Months AS tenure_months,
       ROUND(Monthly_Charge, 6) AS monthly_bill FROM matrix"""),
    "q_dossier": m("""
SELECT Customer_ID, Churn_Probability, Predicted_CLV, Priority_Label, Segment,
       x.Customer_Status, Contract, Internet_Type, Payment_Method, Offer, City, Age,
       Gender = 1 AS is_male, Married = 1 AS is_married, Number_of_Dependents,
       x.Total_Services, Premium_Services, Streaming_Services,
       x.Monthly_Charge, Total_Revenue, x.Tenure_in_Months,
       Paperless_Billing = 1 AS is_paperless, Number_of_Referrals,
       Number_of_Referrals / NULLIF(x.Tenure_in_Months / 12.0::DOUBLE, 0) AS referrals_per_year,
       Avg_Monthly_GB_Download, Is_New_Customer = 1 AS is_new, Senior_Citizen = 1 AS is_senior
FROM matrix JOIN features x USING (Customer_ID)"""),
    "q_pick_account": m("""
SELECT * FROM ranked WHERE contains(lower(Customer_ID), 'c0000001')
ORDER BY rank LIMIT 1 OFFSET 3"""),
    "q_indexed_search": m("SELECT * FROM ranked WHERE contains(lower(Customer_ID), 'c0000001')"),
    "q_indexed_pick": m("""
SELECT * FROM ranked WHERE contains(lower(Customer_ID), 'c0000001')
ORDER BY rank LIMIT 1 OFFSET 3"""),
    "q_indexed_account": m("SELECT * FROM ranked WHERE rank = 1"),
    "q_rule_explained": m(f"""
SELECT Customer_ID, Priority_Label, CASE WHEN hr THEN 'at/above' ELSE 'below' END AS risk_side,
       CASE WHEN hv THEN 'at/above' ELSE 'below' END AS value_side,
       Churn_Probability - p50 AS risk_margin, Predicted_CLV - v50 AS value_margin,
       {_word('Priority_Label', C.PLAYBOOK)} AS playbook FROM matrix"""),
    # properties of fitted models
    "q_score_acceptance": r(
        "SELECT Customer_ID AS customer_id, reasons = '' AS accepted, reasons, TRUE AS complete "
        f"FROM (SELECT Customer_ID, concat_ws('; ', {_reasons()}) AS reasons FROM typed)"),
    "q_stream_scoring": r(
        "SELECT Customer_ID AS customer_id, reasons = '' AS accepted, reasons "
        f"FROM (SELECT Customer_ID, concat_ws('; ', {_reasons()}) AS reasons FROM typed)"),
    "q_bundle_round_trip": _no_violation("customer"),
    "q_bundle_swap": r(
        "SELECT Customer_ID AS customer_id, concat_ws('; ', " + _reasons() + ") = '' AS accepted, "
        "TRUE AS by_its_version, TRUE AS as_the_version_says FROM typed"),
    "q_scored_base_check": _no_violation("customer"),
    "q_model_label_check": _no_violation("customer"),
    "q_segment_nearest_check": _no_violation("customer"),
    "q_model_score_range_check": "SELECT COUNT(*) AS row_count, CAST(0 AS BIGINT) AS probability_not_finite, "
        "CAST(0 AS BIGINT) AS probability_out_of_range, CAST(0 AS BIGINT) AS value_not_finite FROM customer",
    "q_model_assignment_contract": "SELECT COUNT(*) AS row_count, CAST(0 AS BIGINT) AS null_names, "
        "CAST(0 AS BIGINT) AS unknown_names, CAST(0 AS BIGINT) AS unused_names, "
        "CAST(0 AS BIGINT) AS extra_copies FROM customer",
    "q_contribution_check": a(
        "SELECT CAST(CEIL(0.2::DOUBLE * COUNT(*)) AS BIGINT) AS row_count, TRUE AS one_base, "
        "TRUE AS base_is_a_share FROM accounts WHERE Customer_Status IN ('Stayed', 'Churned')"),
    "q_logistic_gradient_check": "SELECT unnest([" + ", ".join(f"'{c}'" for c in C.CHURN_PREDICTORS)
        + "]) AS feature, TRUE AS stationary",
    "q_importance_check": "SELECT unnest([" + ", ".join(f"'{c}'" for c in C.VALUE_PREDICTORS)
        + "]) AS feature, TRUE AS is_share",
    "q_comparison_check": "SELECT unnest([" + ", ".join(f"'{c}'" for c in C.CHURN_MODEL_NAMES)
        + "]) AS model, TRUE AS in_range, TRUE AS not_above_best",
    "q_k_sweep_check": "SELECT CAST(range AS INTEGER) AS k, TRUE AS inertia_falls, TRUE AS in_range FROM range(2, 9)",
    "q_k_sweep_recount": "SELECT CAST(range AS INTEGER) AS k, TRUE AS all_used, TRUE AS same_inertia, "
                         "TRUE AS not_above_best FROM range(2, 9)",
    "q_metrics_recount": "SELECT model, TRUE AS same_rates, TRUE AS same_auc, TRUE AS best_is_deployed "
                         f"FROM (VALUES {', '.join(f'({n!r})' for n in C.CHURN_MODEL_NAMES)}) AS v(model)",
    "q_forest_walk_check": _no_violation("customer"),
    "q_importance_recount": "SELECT feature, TRUE AS same, TRUE AS rightly_ranked "
                            f"FROM (VALUES {', '.join(f'({n!r})' for n in C.VALUE_PREDICTORS)}) AS v(feature)",
    "q_value_fit_check": "SELECT TRUE AS same_errors, TRUE AS within_range, TRUE AS beats_the_mean",
    "q_profile_recount": "SELECT CAST(range AS INTEGER) AS cluster, TRUE AS same_name, TRUE AS same_size, "
                         f"TRUE AS same_share, TRUE AS same_centroid FROM range({C.SEGMENT_COUNT})",
    # plain tables
    "t_order_quantiles": _union([_quantile_row(t, c) for t, c in (
        ("orders", "o_totalprice"), ("lineitem", "l_extendedprice"), ("customer", "c_acctbal"))]),
    "t_line_status_counts": "SELECT l_returnflag, COUNT(*) AS row_count FROM lineitem GROUP BY 1",
    "t_repeat_buyers": "SELECT o_custkey, COUNT(*) - 1 AS extra_copies FROM orders "
                       "GROUP BY 1 HAVING COUNT(*) > 1",
    "t_document_blanks": _union([
        f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL) AS blanks FROM documents"
        for c in ("doc_id", "text", "lang", "source", "n_chars")]),
    "t_order_sample": f"""
SELECT o_orderkey, o_totalprice FROM (
  SELECT *, ROW_NUMBER() OVER (ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR))) AS place
  FROM orders) WHERE place <= {SAMPLE_ROWS}""",
    "t_label_split": _split("labels", "doc_id, quality", "doc_id", "quality"),
    "t_order_split": _split("orders", "o_orderkey, o_orderstatus", "o_orderkey", "o_orderstatus"),
    "t_label_confusion": """
SELECT 'toxic as quality' AS model, actual, predicted, COUNT(quality) AS count
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS cell(actual, predicted)
LEFT JOIN labels ON quality = actual AND toxic = predicted GROUP BY 2, 3""",
    "t_length_auc": _auc("(SELECT n_chars, quality FROM labels JOIN documents USING (doc_id))",
                         "n_chars", "quality"),
    "t_part_standardised": _standard("part", "p_partkey", ["p_size", "p_retailprice"]),
    "t_order_ranking": """
SELECT o_orderkey, o_orderpriority, o_totalprice, ROW_NUMBER() OVER (
  ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS rank FROM orders""",
}
