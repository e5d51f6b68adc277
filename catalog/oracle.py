"""SQL twins of the registered queries, written independently of the Spark code.

They start from the same supplied tables; answer texts and display labels are shared, points,
edges and ranges are stated anew.
"""

from __future__ import annotations

from catalog import frames as R
from scorelab import vocabulary as V


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def texts(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def pick(index: str, values) -> str:
    return f"({texts(values)})[({index}) + 1]"


def tokens(digits: str) -> str:
    return f"array_to_string(string_split({digits}, ''), ';')"


def points(column: str, answers: dict, otherwise: str) -> str:
    cases = " ".join(
        f"WHEN {text(t)} THEN {text(v) if isinstance(v, str) else v}" for t, v in answers.items()
    )
    return f"CASE {column} {cases} ELSE {otherwise} END"


def rated(answers, values: list) -> dict:
    """Answer texts in declared order with the points stated here."""
    return dict(zip(answers, values, strict=True))


def count_tokens(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN 0 ELSE len(string_split({column}, ';')) END"


USAGE, AGENTS = list(V.USAGE_POINTS), list(V.AGENT_POINTS)

RESP = f"""
numbers AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderpriority AS pr, o_orderstatus AS st, month(o_orderdate) AS mon,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents, CAST(floor(o_totalprice) AS BIGINT) % 60 AS wy
  FROM orders
),
digits AS (
  SELECT *, CAST(cents AS VARCHAR) AS d, reverse(CAST(cents AS VARCHAR)) AS b, cents % 54 AS cy FROM numbers
),
resp AS (
  SELECT
    CAST(k AS VARCHAR) AS "ResponseId",
    {pick("k % 3", ["I am a developer by profession", "I code sometimes"])} AS "MainBranch",
    CASE WHEN wy <= 52 THEN CAST(wy AS VARCHAR) WHEN wy = 53 THEN 'not stated'
         WHEN wy = 57 THEN '5.5' WHEN wy = 58 THEN '10.5' END AS "WorkExp",
    CASE WHEN cy = 0 THEN 'Less than 1 year' WHEN cy = 51 THEN 'More than 50 years'
         WHEN cy = 52 THEN 'not stated' WHEN cy = 53 THEN NULL ELSE CAST(cy AS VARCHAR) END AS "YearsCode",
    {pick("c % 12", R.ROLES)} AS "DevType",
    {pick("c % 7", R.WORK_MODES)} AS "RemoteWork",
    CASE WHEN c % 27 <> 26 THEN 'NATION_' || CAST(c % 25 AS VARCHAR) END AS "Country",
    {pick("c % 4", ["Software", "Finance", "Retail"])} AS "Industry",
    {pick("k % 4", ["Yes", "I'm not sure", "No"])} AS "AIThreat",
    CASE pr WHEN '1-URGENT' THEN {text(USAGE[0])} WHEN '2-HIGH' THEN {text(USAGE[1])}
            WHEN '3-MEDIUM' THEN {text(USAGE[2])}
            WHEN '5-LOW' THEN (CASE WHEN k % 2 = 0 THEN {text(USAGE[3])} ELSE {text(USAGE[4])} END) END AS "AISelect",
    {pick("mon % 7", [*V.SENTIMENT_POINTS, R.UNSURE_SENTIMENT])} AS "AISent",
    {pick("c % 6", list(V.ACCURACY_POINTS))} AS "AIAcc",
    {pick("k % 7", [*V.COMPLEX_POINTS, R.UNSURE_COMPLEX])} AS "AIComplex",
    CASE WHEN c % 5 <> 0 THEN {tokens("left(b, 1 + k % 8)")} END AS "AIToolCurrently partially AI",
    CASE WHEN st <> 'O' THEN {tokens("left(d, 1 + c % 6)")} END AS "AIToolCurrently mostly AI",
    CASE WHEN c % 13 <> 0 THEN
      replace(replace({tokens("left(reverse(CAST(k AS VARCHAR)), 1 + c % 6)")},
              '8', {text(V.NOT_A_PROBLEM[0])}), '9', {text(V.NOT_A_PROBLEM[1])}) END AS "AIFrustration",
    CASE st WHEN 'F' THEN {pick("k % 3", AGENTS[:3])} WHEN 'P' THEN {text(AGENTS[3])}
            ELSE {pick("c % 3", AGENTS[4:])} END AS "AIAgents",
    CASE WHEN c % 11 <> 0 THEN {tokens("left(d || CAST(c AS VARCHAR), 1 + k % 13)")} END AS "AIModelsHaveWorkedWith",
    CASE WHEN c % 9 <> 0 THEN {tokens("left(b, 1 + k % 5)")} END AS "DevEnvsHaveWorkedWith"
  FROM digits
)
"""

CLEAN = RESP + """,
cleaned AS (
  SELECT * REPLACE (
      coalesce("DevType", 'Unknown') AS "DevType", coalesce("Country", 'Unknown') AS "Country",
      coalesce("RemoteWork", 'Unknown') AS "RemoteWork", coalesce("Industry", 'Unknown') AS "Industry",
      coalesce("AISelect", 'Unknown') AS "AISelect", coalesce("AIFrustration", 'None reported') AS "AIFrustration",
      coalesce("AIThreat", 'Unknown') AS "AIThreat", coalesce("AIAgents", 'Unknown') AS "AIAgents",
      coalesce("AISent", 'Unknown') AS "AISent", coalesce("AIAcc", 'Unknown') AS "AIAcc",
      coalesce("AIComplex", 'Unknown') AS "AIComplex"),
    TRY_CAST("WorkExp" AS DOUBLE) AS "WorkExpNum",
    CASE "YearsCode" WHEN 'Less than 1 year' THEN 0.0::DOUBLE WHEN 'More than 50 years' THEN 51.0::DOUBLE
         ELSE TRY_CAST("YearsCode" AS DOUBLE) END AS "YearsCodeNum"
  FROM resp
)
"""

PROBLEMS = f"""(SELECT count(DISTINCT t) FROM unnest(string_split("AIFrustration", ';')) u(t)
  WHERE t NOT IN ({", ".join(text(t) for t in V.NOT_A_PROBLEM)}))"""

SCORED = CLEAN + f""",
components AS (
  SELECT *,
    {points('"AISelect"', rated(V.USAGE_POINTS, [5, 4, 3, 2, 1]), "0")} AS "UsageFreq",
    {points('"AIAgents"', rated(V.AGENT_POINTS, [5, 4, 3, 2, 1, 0]), "0")} AS "AgentDepth",
    {count_tokens('"AIModelsHaveWorkedWith"')} AS "AIModelCount",
    {count_tokens('"AIToolCurrently mostly AI"')} AS "TasksMostlyAI",
    {count_tokens('"AIToolCurrently partially AI"')} AS "TasksPartiallyAI",
    {count_tokens('"DevEnvsHaveWorkedWith"')} AS "DevEnvToolCount",
    {points('"AIAcc"', rated(V.ACCURACY_POINTS, [5, 4, 3, 2, 1]), "NULL")} AS "TrustAcc",
    {points('"AIComplex"', rated(V.COMPLEX_POINTS, [5, 4, 3, 2, 1]), "NULL")} AS "TrustComplex",
    {points('"AISent"', rated(V.SENTIMENT_POINTS, [5, 4, 3, 2, 1]), "NULL")} AS "Sentiment",
    CASE WHEN "AIFrustration" = 'None reported' THEN 0 ELSE {PROBLEMS} END AS "ProblemCount",
    CAST({points('"AIThreat"', rated(V.THREAT_POINTS, [1.0, 0.5]), "0.0")} AS DOUBLE) AS "ThreatLevel"
  FROM cleaned
),
mixed AS (
  SELECT *, least("TasksMostlyAI" + "TasksPartiallyAI" * 0.5::DOUBLE, 10.0::DOUBLE) AS "WorkflowIntegration" FROM components
),
scored AS (
  SELECT *,
    ("UsageFreq" / 5.0::DOUBLE + "AgentDepth" / 5.0::DOUBLE + least("AIModelCount", 10) / 10.0::DOUBLE
      + "WorkflowIntegration" / 10.0::DOUBLE) / 4.0::DOUBLE * 100.0::DOUBLE AS "UsageScore",
    (("TrustAcc" - 1) / 4.0::DOUBLE + ("TrustComplex" - 1) / 4.0::DOUBLE + ("Sentiment" - 1) / 4.0::DOUBLE)
      / 3.0::DOUBLE * 100.0::DOUBLE AS "TrustScore",
    (least("ProblemCount", 5) / 5.0::DOUBLE + "ThreatLevel") / 2.0::DOUBLE * 100.0::DOUBLE AS "FrustrationScore"
  FROM mixed
)
"""

QUADS = SCORED + f""",
analysed AS (SELECT * FROM scored WHERE "TrustScore" IS NOT NULL),
cuts AS (SELECT quantile_disc("UsageScore", 0.5) AS u, quantile_disc("TrustScore", 0.5) AS t FROM analysed),
quads AS (
  SELECT a.*, (CASE WHEN "UsageScore" >= u THEN 'High' ELSE 'Low' END) || ' Usage - '
              || (CASE WHEN "TrustScore" >= t THEN 'High' ELSE 'Low' END) || ' Trust' AS "TrustUsageGroup",
         CASE WHEN "UsageScore" >= u AND "TrustScore" < t THEN 1 ELSE 0 END AS "ParadoxLabel"
  FROM analysed a, cuts
)
"""


def avg(column: str, name: str) -> str:
    return f'round(avg("{column}"), 6) AS "{name}"'


AVERAGES = ", ".join(
    avg(c, n) for c, n in (("UsageScore", "AvgUsageScore"), ("TrustScore", "AvgTrustScore"),
                           ("FrustrationScore", "AvgFrustrationScore"))
)
RAW_AVERAGES = ('avg("UsageScore") AS "AvgUsageScore", avg("TrustScore") AS "AvgTrustScore", '
                'avg("FrustrationScore") AS "AvgFrustrationScore"')

BAND = """CASE WHEN "UsageScore" < 25 THEN 'Low (0-25)' WHEN "UsageScore" < 50 THEN 'Medium-Low (25-50)'
    WHEN "UsageScore" < 75 THEN 'Medium-High (50-75)' ELSE 'High (75-100)' END"""
STAGE = """CASE WHEN "WorkExpNum" IS NULL THEN 'Unknown' WHEN "WorkExpNum" < 2 THEN 'Beginner: 0-1 years'
    WHEN "WorkExpNum" BETWEEN 2 AND 5 THEN 'Junior: 2-5 years' WHEN "WorkExpNum" BETWEEN 6 AND 10 THEN 'Mid-level: 6-10 years'
    WHEN "WorkExpNum" BETWEEN 11 AND 20 THEN 'Senior: 11-20 years' ELSE 'Expert: 20+ years' END"""
STAGES = SCORED + f""",
stages AS (SELECT {STAGE} AS "ExperienceGroup", count(*) AS "DeveloperCount", {RAW_AVERAGES} FROM scored GROUP BY 1)
"""
ROLES = SCORED + f""",
roles AS (SELECT "DevType", count(*) AS "DeveloperCount", {RAW_AVERAGES} FROM scored
          WHERE "DevType" <> 'Unknown' GROUP BY 1 HAVING count(*) >= 100)
"""
FOCUS = QUADS + """,
focus AS (
  SELECT "DevType", "Country", "RemoteWork", count(*) AS "DeveloperCount", round(avg("WorkExpNum"), 6) AS "AvgWorkExperience",
         round(avg("FrustrationScore"), 6) AS "AvgFrustration", round(avg("AgentDepth"), 6) AS "AvgAgentDepth"
  FROM quads WHERE "TrustUsageGroup" = 'High Usage - Low Trust' AND "DevType" <> 'Unknown'
  GROUP BY 1, 2, 3 HAVING count(*) >= 3
),
topc AS (SELECT "Country", CAST(sum("DeveloperCount") AS BIGINT) AS "Developers" FROM focus GROUP BY 1
         ORDER BY 2 DESC, 1 LIMIT 8)
"""
MODE = points('"RemoteWork"', V.WORK_MODE_LABELS, "'Other'")
ROLE_LABEL = points('"DevType"', V.ROLE_LABELS, """replace(replace("DevType", 'Developer, ', ''), ' or ', ' / ')""")
SLICE = QUADS + f""",
slice AS (
  SELECT * FROM quads
  WHERE "DevType" IN ({", ".join(text(r) for r in R.ROLES[:6])})
    AND "Country" IN ({", ".join(text(f"NATION_{i}") for i in range(20))})
    AND ("WorkExpNum" BETWEEN 2 AND 30 OR "WorkExpNum" IS NULL)
)
"""
RATED = """
base AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
                ((l_orderkey * 7919 + l_linenumber * 104729) % 1000) / 1000.0::DOUBLE AS score FROM lineitem),
rated AS (SELECT y, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS guess FROM base)
"""
BINARY = RATED + """,
cells AS (SELECT count(*) FILTER (y = 1 AND guess = 1) AS tp, count(*) FILTER (y = 0 AND guess = 1) AS fp,
                 count(*) FILTER (y = 1 AND guess = 0) AS fn, count(*) FILTER (y = 0 AND guess = 0) AS tn FROM rated),
record AS (
  SELECT tp + fp + fn + tn AS n, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
         round((tn + fp) / (tp + fp + fn + tn), 6) AS baseline_accuracy,
         round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced_accuracy,
         round(tp / (tp + fp), 6) AS "precision", round(tp / (tp + fn), 6) AS recall,
         round(2 * tp / (2 * tp + fp + fn), 6) AS f1
  FROM cells)
"""
USAGE_LABEL = points('"AISelect"', V.USAGE_LABELS, '"AISelect"')
SPLIT = QUADS + """,
hashed AS (SELECT *, md5('42:' || "ResponseId") AS h FROM quads),
placed AS (SELECT *, row_number() OVER (PARTITION BY "ParadoxLabel" ORDER BY h) AS place FROM hashed),
sizes AS (SELECT "ParadoxLabel" AS l, count(*) AS n FROM quads GROUP BY 1),
quota AS (SELECT l, n, sum(n) OVER () AS total, CAST(ceil(sum(n) OVER () * 0.2) AS BIGINT) AS test FROM sizes),
shares AS (SELECT l, CAST((n * test) // total AS BIGINT) AS base, (n * test) % total AS rest, test FROM quota),
given AS (SELECT l, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, l) <= test - sum(base) OVER () THEN 1 ELSE 0 END
          AS take FROM shares),
split AS (SELECT p.*, p.place <= g.take AS is_test FROM placed p JOIN given g ON p."ParadoxLabel" = g.l)
"""
COMPLETE = '"WorkExpNum" IS NOT NULL'  # the only model column that can be missing beside trust
DENSITY = SCORED + """,
cells AS (SELECT CAST(least(floor("UsageScore" / 10), 9) * 10 AS BIGINT) AS u_bin,
                 CAST(least(floor("TrustScore" / 10), 9) * 10 AS BIGINT) AS t_bin, count(*) AS "Developers"
          FROM scored WHERE "UsageScore" IS NOT NULL AND "TrustScore" IS NOT NULL GROUP BY 1, 2)
"""
ANALYSED_COUNT = "(SELECT count(*) FROM quads)"


def unit(seed: int) -> str:
    return f"""(CAST('0x' || substr(md5('{seed}:' || "ResponseId"), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE * 0.9 - 0.45)"""


def roc(name: str, source: str) -> str:
    """Mann-Whitney form: tied scores take their mean rank."""
    return f"""
    SELECT '{name}' AS score, round((sum(y * mean_rank) - p * (p + 1) / 2.0::DOUBLE) / (p * q), 6) AS roc_auc
    FROM (SELECT y, avg(place) OVER (PARTITION BY v) AS mean_rank, sum(y) OVER ()::DOUBLE AS p, sum(1 - y) OVER ()::DOUBLE AS q
          FROM (SELECT y, v, row_number() OVER (ORDER BY v)::DOUBLE AS place FROM ({source}))) GROUP BY p, q"""


def silhouette(distance: str, sample: str = "") -> str:
    return f"""
    WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings {sample}),
    d AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum({distance}) AS s, count(*) AS n
          FROM e a, e b GROUP BY 1, 2, 3),
    r AS (SELECT vec_id, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a,
                 min(CASE WHEN own <> other THEN s / n END) AS b FROM d GROUP BY 1)
    SELECT round(avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
    FROM r"""


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()} {select}"


DESCRIBED = ["UsageFreq", "AgentDepth", "AIModelCount", "WorkflowIntegration", "UsageScore", "TrustAcc",
             "TrustComplex", "Sentiment", "TrustScore", "ProblemCount", "ThreatLevel", "FrustrationScore"]

ORACLE: dict[str, str] = {
    # sources
    "csv_roundtrip": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(text, 'NA') AS text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents",
    "csv_split_roundtrip": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(text, 'NA') AS text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents",
    "report_roundtrip": with_(SCORED, f'SELECT {BAND} AS "UsageBand", count(*) AS "DeveloperCount", {AVERAGES} FROM scored GROUP BY 1'),
    "metrics_roundtrip": with_(BINARY, "SELECT * FROM record"),
    "table_roundtrip": with_(QUADS, 'SELECT "TrustUsageGroup", count(*) AS n, count(DISTINCT "ResponseId") AS respondents FROM quads GROUP BY 1'),
    "optional_source": "SELECT count(*) AS row_count, true AS absent_is_none FROM orders",
    "sql_view_profile": with_(SCORED, """SELECT CASE WHEN "UsageScore" < 50 THEN 'lower' ELSE 'upper' END AS half,
        count(*) AS n, count("TrustScore") AS n_trust, round(avg("TrustScore"), 6) AS avg_trust
        FROM scored GROUP BY 1 HAVING count(*) >= 10"""),
    "sum_of_squares": "SELECT sum(l_quantity) AS total, sum(l_quantity * l_quantity) AS total_squares FROM lineitem",
    "preview_rows": with_(SCORED, """SELECT "ResponseId", round("UsageScore", 6) AS "UsageScore", round("TrustScore", 6) AS "TrustScore",
        round("FrustrationScore", 6) AS "FrustrationScore" FROM scored ORDER BY "ResponseId" LIMIT 5"""),
    # cleaning
    "select_available_columns": with_(RESP, """SELECT "ResponseId", "DevType", "AIToolCurrently mostly AI", 'No such column' AS missing FROM resp"""),
    "dedupe_by_key": """SELECT * EXCLUDE (place) REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS place
        FROM lineitem) WHERE place = 1""",
    "clean_responses": with_(CLEAN, """SELECT "ResponseId", "DevType", "Country", "AISelect", "AIFrustration", "WorkExpNum", "YearsCodeNum" FROM cleaned"""),
    "fill_defaults": with_(CLEAN, """SELECT "ResponseId", "AISelect", "AIFrustration", "RemoteWork", "WorkExp" FROM cleaned"""),
    "drop_incomplete_rows": with_(RESP, """SELECT "ResponseId", "AIAcc", "DevType", "WorkExp", "Country" FROM resp
        WHERE "AIAcc" IS NOT NULL AND "DevType" IS NOT NULL AND "WorkExp" IS NOT NULL AND "Country" IS NOT NULL"""),
    "drop_incomplete": with_(RESP, """SELECT "ResponseId", "AIAcc", "DevType", "WorkExp" FROM resp WHERE "AIAcc" IS NOT NULL AND "DevType" IS NOT NULL"""),
    "numeric_parse": with_(RESP, """SELECT "ResponseId", TRY_CAST("WorkExp" AS DOUBLE) AS years FROM resp"""),
    "numeric_parse_edges": with_(CLEAN, """SELECT "ResponseId", "YearsCodeNum" AS years FROM cleaned"""),
    # encoding
    "ordinal_encode_default": with_(SCORED, """SELECT "ResponseId", "UsageFreq", "AgentDepth" FROM scored"""),
    "ordinal_encode_nullable": with_(SCORED, """SELECT "ResponseId", "TrustAcc", "TrustComplex", "Sentiment" FROM scored"""),
    "fractional_encode": with_(SCORED, """SELECT "ResponseId", "ThreatLevel" FROM scored"""),
    "multiselect_count": with_(SCORED, """SELECT "ResponseId", CAST("AIModelCount" AS BIGINT) AS models,
        CAST(least("AIModelCount", 10) AS BIGINT) AS models_capped, CAST("DevEnvToolCount" AS BIGINT) AS tools FROM scored"""),
    "multiselect_count_excluding": with_(SCORED, """SELECT "ResponseId", CAST("ProblemCount" AS BIGINT) AS problems FROM scored"""),
    "weighted_integration": with_(SCORED, """SELECT "ResponseId", "WorkflowIntegration" AS integration FROM scored"""),
    "relabel": with_(CLEAN, f"""SELECT "ResponseId", {USAGE_LABEL} AS usage_label, {MODE} AS work_mode,
        CAST({points('"DevType"', {r: i for i, r in enumerate(R.ROLES[:5])}, "99")} AS BIGINT) AS role_rank FROM cleaned"""),
    "shorten_label": with_(CLEAN, f"""SELECT "ResponseId", {ROLE_LABEL} AS role FROM cleaned"""),
    "display_text": with_(SCORED, """SELECT "DevType", format('{:,}', count(*)) AS count_text, printf('%.2f', avg("UsageScore")) AS usage_text,
        printf('%.3f', count(*) * 100.0::DOUBLE / (SELECT count(*) FROM scored)) || '%' AS share_text FROM scored GROUP BY 1"""),
    "share_of_total": with_(SCORED, """SELECT "AISelect", count(*) AS "DeveloperCount",
        round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM scored), 6) AS "Share" FROM scored GROUP BY 1"""),
    "seeded_jitter": with_(RESP, f"""SELECT "ResponseId", round({unit(1)}, 6) AS jitter FROM resp"""),
    # scores
    "composite_score": with_(SCORED, """SELECT "ResponseId", round("UsageScore", 6) AS "UsageScore", round("FrustrationScore", 6) AS "FrustrationScore" FROM scored"""),
    "composite_score_strict": with_(SCORED, """SELECT "ResponseId", round("TrustScore", 6) AS "TrustScore" FROM scored"""),
    "describe_scores": with_(SCORED, " UNION ALL ".join(
        f"""SELECT '{c}' AS "Column", count("{c}") AS "Count", round(avg("{c}"), 6) AS "Mean", round(stddev_samp("{c}"), 6) AS "StdDev",
        round(min("{c}")::DOUBLE, 6) AS "Min", round(max("{c}")::DOUBLE, 6) AS "Max" FROM scored""" for c in DESCRIBED)),
    # segments
    "median_cut": with_(QUADS, """SELECT round(u, 6) AS "UsageScore", round(t, 6) AS "TrustScore" FROM cuts"""),
    "median_cut_many_values": "SELECT quantile_disc(l_extendedprice, 0.5) AS l_extendedprice, quantile_disc(l_quantity, 0.5) AS l_quantity FROM lineitem",
    "median_quadrants": with_(QUADS, """SELECT "ResponseId", round("UsageScore", 6) AS "UsageScore", round("TrustScore", 6) AS "TrustScore", "TrustUsageGroup" FROM quads"""),
    "label_distribution": with_(QUADS, """SELECT CAST("ParadoxLabel" AS BIGINT) AS "ParadoxLabel", count(*) AS n FROM quads GROUP BY 1"""),
    "trust_bands": with_(SCORED, f"""SELECT CASE WHEN "TrustScore" IS NULL THEN 'none' WHEN "TrustScore" < 25 THEN 'low' WHEN "TrustScore" < 50 THEN 'middle'
        WHEN "TrustScore" < 75 THEN 'upper' ELSE 'high' END AS band, count(*) AS "DeveloperCount", {avg("UsageScore", "avg_usage")} FROM scored GROUP BY 1"""),
    "hist2d": with_(DENSITY, "SELECT * FROM cells"),
    "hist2d_dense": with_(DENSITY, """SELECT CAST(a.i * 10 AS BIGINT) AS u_bin, CAST(b.i * 10 AS BIGINT) AS t_bin, coalesce("Developers", 0) AS "Developers"
        FROM range(10) a(i) CROSS JOIN range(10) b(i) LEFT JOIN cells ON u_bin = a.i * 10 AND t_bin = b.i * 10"""),
    # reports
    "dataset_summary": with_(SCORED, f"""SELECT count(*) AS "TotalResponses", count("TrustScore") AS "RespondentsWithTrust",
        count(DISTINCT "Country") AS "CountryCount", count(DISTINCT "DevType") AS "DeveloperRoleCount", {AVERAGES} FROM scored"""),
    "category_distribution": with_(SCORED, 'SELECT "AISelect", count(*) AS "DeveloperCount" FROM scored GROUP BY 1'),
    "usage_band_profile": with_(SCORED, f'SELECT {BAND} AS "UsageBand", count(*) AS "DeveloperCount", {AVERAGES} FROM scored GROUP BY 1'),
    "role_profile": with_(SCORED, f"""SELECT "DevType", count(*) AS "DeveloperCount", {AVERAGES} FROM scored WHERE "DevType" <> 'Unknown'
        GROUP BY 1 HAVING count(*) >= 100"""),
    "experience_profile": with_(SCORED, f'SELECT {STAGE} AS "ExperienceGroup", count(*) AS "DeveloperCount", {AVERAGES} FROM scored GROUP BY 1'),
    "quadrant_summary": with_(QUADS, f"""SELECT "TrustUsageGroup", count(*) AS "DeveloperCount", {AVERAGES}, {avg("AgentDepth", "AvgAgentDepth")},
        {avg("AIModelCount", "AvgModelCount")}, {avg("WorkflowIntegration", "AvgWorkflowIntegration")} FROM quads GROUP BY 1"""),
    "segment_profile": with_(FOCUS, "SELECT * FROM focus"),
    # chart datasets
    "ordered_categories": with_(SCORED, f"""SELECT "AISelect", {USAGE_LABEL} AS "Label", count(*) AS "DeveloperCount",
        format('{{:,}}', count(*)) AS "CountLabel" FROM scored GROUP BY 1"""),
    "band_lines": with_(SCORED, f"""SELECT {points("band", {b: i for i, b in enumerate(V.USAGE_BANDS)}, "99")}::BIGINT AS x, band AS "UsageBand", n AS "DeveloperCount",
        round(t, 6) AS "AvgTrustScore", round(f, 6) AS "AvgFrustrationScore", printf('%.1f', t) AS "TrustLabel", printf('%.1f', f) AS "FrustrationLabel",
        format('{{:,}}', n) AS "CountLabel"
        FROM (SELECT {BAND} AS band, count(*) AS n, avg("TrustScore") AS t, avg("FrustrationScore") AS f FROM scored GROUP BY 1)"""),
    "scatter_points": with_(QUADS, f"""SELECT "ResponseId", round("UsageScore" + {unit(1)}, 6) AS x, round("TrustScore" + {unit(2)}, 6) AS y,
        round("FrustrationScore", 6) AS "FrustrationScore", round(u, 6) AS "UsageCut", round(t, 6) AS "TrustCut"
        FROM (SELECT *, row_number() OVER (ORDER BY md5('0:' || "ResponseId")) AS place FROM quads), cuts WHERE place <= 5000"""),
    "quadrant_sizes": with_(QUADS, f"""SELECT "TrustUsageGroup", count(*) AS "DeveloperCount", round(count(*) * 100.0::DOUBLE / {ANALYSED_COUNT}, 6) AS "Share",
        printf('%.1f', count(*) * 100.0::DOUBLE / {ANALYSED_COUNT}) || '%' AS "ShareLabel", format('{{:,}}', count(*)) AS "CountLabel" FROM quads GROUP BY 1"""),
    "quadrants_by_frustration": with_(QUADS, f"""SELECT "TrustUsageGroup", {avg("FrustrationScore", "AvgFrustrationScore")} FROM quads GROUP BY 1"""),
    "experience_lines": with_(STAGES, f"""SELECT CAST({points('"ExperienceGroup"', {g: i for i, g in enumerate(V.EXPERIENCE_GROUPS)}, "99")} AS BIGINT) AS x,
        "ExperienceGroup", {points('"ExperienceGroup"', V.EXPERIENCE_SHORT, "NULL")} AS "Label", "DeveloperCount", round("AvgTrustScore", 6) AS "AvgTrustScore",
        (SELECT round(max("AvgTrustScore") - min("AvgTrustScore"), 6) FROM stages WHERE "ExperienceGroup" <> 'Unknown') AS "KnownSpread",
        (SELECT round(max("AvgTrustScore") - min("AvgTrustScore"), 6) FROM stages) AS "AllSpread" FROM stages"""),
    "group_mean_spread": with_(STAGES, """SELECT round(max("AvgTrustScore") - min("AvgTrustScore"), 6) AS all_spread,
        round(max("AvgTrustScore") FILTER ("ExperienceGroup" <> 'Unknown') - min("AvgTrustScore") FILTER ("ExperienceGroup" <> 'Unknown'), 6) AS known_spread
        FROM stages"""),
    "density_points": with_(DENSITY, """SELECT *, u_bin + 5 AS x, t_bin + 5 AS y, u_bin || '-' || (u_bin + 10) AS "UsageBin", t_bin || '-' || (t_bin + 10) AS "TrustBin" FROM cells"""),
    "role_extremes": with_(ROLES, f"""SELECT "DevType", {ROLE_LABEL} AS "RoleLabel", "DeveloperCount", round("AvgTrustScore", 6) AS "AvgTrustScore",
        "AvgTrustScore" >= (SELECT median("AvgTrustScore") FROM roles) AS "AboveMedian", printf('%.1f', "AvgTrustScore") AS "TrustLabel",
        format('{{:,}}', "DeveloperCount") AS "CountLabel"
        FROM (SELECT *, row_number() OVER (ORDER BY "AvgTrustScore", "DevType") AS lo, row_number() OVER (ORDER BY "AvgTrustScore" DESC, "DevType") AS hi FROM roles WHERE "AvgTrustScore" IS NOT NULL)
        WHERE lo <= 3 OR hi <= 4"""),
    "role_extremes_selected": with_(ROLES, f""", picked AS (SELECT * FROM
        (SELECT *, row_number() OVER (ORDER BY "AvgTrustScore", "DevType") AS lo, row_number() OVER (ORDER BY "AvgTrustScore" DESC, "DevType") AS hi FROM roles WHERE "AvgTrustScore" IS NOT NULL)
        WHERE lo <= 5 OR hi <= 3)
        SELECT "DevType", {ROLE_LABEL} AS "RoleLabel", "DeveloperCount", round("AvgTrustScore", 6) AS "AvgTrustScore",
        "AvgTrustScore" >= (SELECT median("AvgTrustScore") FROM picked) AS "AboveMedian", printf('%.1f', "AvgTrustScore") AS "TrustLabel",
        format('{{:,}}', "DeveloperCount") AS "CountLabel" FROM picked"""),
    "extreme_roles": with_(ROLES, """SELECT arg_max("DevType", "AvgTrustScore") AS "HighestKey", round(max("AvgTrustScore"), 6) AS "HighestValue",
        arg_min("DevType", "AvgTrustScore") AS "LowestKey", round(min("AvgTrustScore"), 6) AS "LowestValue" FROM roles"""),
    "country_totals": with_(FOCUS, "SELECT * FROM topc"),
    "top_groups_detail": with_(FOCUS, f"""SELECT *, {MODE} AS "WorkMode" FROM focus WHERE "Country" IN (SELECT "Country" FROM topc)"""),
    "country_work_modes": with_(FOCUS, "SELECT \"Country\", " + ", ".join(
        f"""CAST(coalesce(sum("DeveloperCount") FILTER (({MODE}) = {text(m)}), 0) AS BIGINT) AS "{m}\"""" for m in V.WORK_MODE_ORDER)
        + ' FROM focus WHERE "Country" IN (SELECT "Country" FROM topc) GROUP BY 1'),
    "pivot_counts": "SELECT user_id, " + ", ".join(f"count(*) FILTER (event_type = '{t}') AS {t}" for t in ("click", "view", "purchase", "error", "never"))
        + " FROM events GROUP BY 1",
    "top_values": "SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 15",
    "top_common_values": "SELECT lang, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, lang LIMIT 1",
    "filter_options": with_(QUADS, """SELECT "Country", count(*) AS "DeveloperCount" FROM quads GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"""),
    "headline_kpis": with_(QUADS + "," + ROLES.split(SCORED)[1].lstrip(" ,\n") + "," + STAGES.split(SCORED)[1].lstrip(" ,\n"),
        f"""SELECT count(*) AS "TotalResponses", count("TrustScore") AS "RespondentsWithTrust", count(DISTINCT "Country") AS "CountryCount",
        count(DISTINCT "DevType") AS "DeveloperRoleCount", {AVERAGES},
        (SELECT count(*) FROM quads WHERE "ParadoxLabel" = 1) AS "FocusCount",
        round((SELECT count(*) FROM quads WHERE "ParadoxLabel" = 1) * 100.0::DOUBLE / count("TrustScore"), 6) AS "FocusShare",
        (SELECT arg_max("DevType", "AvgTrustScore") FROM roles) AS "HighestKey", (SELECT round(max("AvgTrustScore"), 6) FROM roles) AS "HighestValue",
        (SELECT arg_min("DevType", "AvgTrustScore") FROM roles) AS "LowestKey", (SELECT round(min("AvgTrustScore"), 6) FROM roles) AS "LowestValue",
        (SELECT round(max("AvgTrustScore") - min("AvgTrustScore"), 6) FROM stages WHERE "ExperienceGroup" <> 'Unknown') AS "ExperienceSpread"
        FROM scored"""),
    # slice
    "filtered_slice": with_(SLICE, """SELECT "ResponseId", "DevType", "Country", "WorkExpNum", "TrustUsageGroup" FROM slice"""),
    "filtered_known_years": with_(QUADS, """SELECT "ResponseId", "WorkExpNum" FROM quads WHERE "WorkExpNum" <= 50"""),
    "filtered_kpis": with_(SLICE, f"""SELECT count(*) AS "Developers", count(*) FILTER ("ParadoxLabel" = 1) AS "FocusDevelopers",
        round(count(*) FILTER ("ParadoxLabel" = 1) * 100.0::DOUBLE / count(*), 6) AS "FocusShare", {AVERAGES} FROM slice"""),
    "filtered_quadrants": with_(SLICE, """SELECT "TrustUsageGroup", count(*) AS "DeveloperCount", round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM slice), 6) AS "Share",
        printf('%.1f', count(*) * 100.0::DOUBLE / (SELECT count(*) FROM slice)) || '%' AS "ShareLabel", format('{:,}', count(*)) AS "CountLabel" FROM slice GROUP BY 1"""),
    "filtered_top_groups": with_(SLICE, f"""SELECT "DevType", count(*) AS "Developers", {avg("FrustrationScore", "AvgFrustration")}, {ROLE_LABEL} AS "RoleLabel"
        FROM slice WHERE "ParadoxLabel" = 1 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12"""),
    "filtered_top_countries": with_(SLICE, f"""SELECT "Country", count(*) AS "Developers", {avg("FrustrationScore", "AvgFrustration")}
        FROM slice WHERE "ParadoxLabel" = 1 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12"""),
    # samples and splits
    "bounded_sample": with_(SCORED, """SELECT "ResponseId", round("UsageScore", 6) AS "UsageScore" FROM scored
        QUALIFY row_number() OVER (ORDER BY md5('0:' || "ResponseId")) <= 1200"""),
    "stratified_split": with_(SPLIT, """SELECT "ResponseId", CAST("ParadoxLabel" AS BIGINT) AS "ParadoxLabel", is_test FROM split"""),
    # metrics
    "confusion_matrix": with_(RATED, "SELECT CAST(y AS BIGINT) AS y_true, CAST(guess AS BIGINT) AS y_pred, count(*) AS n FROM rated GROUP BY 1, 2"),
    "classification_report": with_(RATED, """, per AS (
        SELECT c, count(*) FILTER (y = c AND guess = c) / count(*) FILTER (guess = c) AS p,
               count(*) FILTER (y = c AND guess = c) / count(*) FILTER (y = c) AS r, count(*) FILTER (y = c) AS s
        FROM rated, (VALUES (0), (1)) v(c) GROUP BY c),
        full_per AS (SELECT *, 2 * p * r / (p + r) AS f FROM per)
        SELECT CAST(c AS VARCHAR) AS class, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1, s AS support FROM full_per
        UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(s) AS BIGINT) FROM full_per
        UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s), 6), round(sum(r * s) / sum(s), 6), round(sum(f * s) / sum(s), 6), CAST(sum(s) AS BIGINT) FROM full_per"""),
    "binary_metrics": with_(BINARY, "SELECT * FROM record"),
    "roc_auc": with_(RATED, roc("score", "SELECT y, score AS v FROM rated") + " UNION ALL "
        + roc("price", "SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_extendedprice AS v FROM lineitem")),
    "ensemble_vote": """SELECT o_orderkey, round(m, 6) AS y_proba, CAST(m >= 0.5 AS BIGINT) AS y_pred FROM (SELECT o_orderkey,
        (((o_orderkey * 7) % 1000) / 1000.0::DOUBLE + ((o_orderkey * 13) % 1000) / 1000.0::DOUBLE + ((o_orderkey * 29) % 1000) / 1000.0::DOUBLE) / 3.0::DOUBLE AS m
        FROM orders)""",
    "metrics_record": with_(SPLIT, f"""SELECT round(avg(CASE WHEN "ParadoxLabel" = ("UsageScore" >= 60)::INTEGER THEN 1 ELSE 0 END) FILTER (is_test), 6) AS accuracy,
        count(*) FILTER (NOT is_test) AS n_train, count(*) FILTER (is_test) AS n_test,
        round(avg("ParadoxLabel") FILTER (NOT is_test), 6) AS positive_rate_train, round(avg("ParadoxLabel") FILTER (is_test), 6) AS positive_rate_test,
        (SELECT round(u, 6) FROM cuts) AS median_usage, (SELECT round(t, 6) FROM cuts) AS median_trust, {text(",".join(V.PREDICTORS))} AS predictors FROM split"""),
    # models
    "standardize": with_(QUADS, ", rows_ AS (SELECT * FROM quads WHERE \"WorkExpNum\" IS NOT NULL) SELECT \"ResponseId\", " + ", ".join(
        f"""round(("{c}" - (SELECT avg("{c}") FROM rows_)) / (SELECT stddev_pop("{c}") FROM rows_), 6) AS "{c}_z\"""" for c in ("UsageScore", "TrustScore", "AIModelCount"))
        + " FROM rows_"),
    "silhouette": silhouette("list_distance(a.x, b.x) ** 2"),
    "silhouette_sampled": silhouette("list_distance(a.x, b.x)", "QUALIFY row_number() OVER (ORDER BY md5('42:' || vec_id)) <= 300"),
    "cluster_means": "SELECT CAST(label AS BIGINT) AS \"Cluster\", " + ", ".join(
        f"round_even(avg(CAST(embedding[{i + 1}] AS DOUBLE)), 3) AS axis{i}" for i in range(64))
        + ', count(*) AS "DeveloperCount" FROM embeddings GROUP BY 1',
    "kmeans_consistency": with_(QUADS, f"SELECT count(*) AS assigned, 4::BIGINT AS clusters, true AS numbered_by_usage FROM quads WHERE {COMPLETE}"),
    "pca_consistency": with_(QUADS, f"SELECT count(*) AS projected, true AS centred, true AS uncorrelated, true AS ordered FROM quads WHERE {COMPLETE}"),
    "rf_consistency": with_(SPLIT.replace("FROM quads", f"FROM (SELECT * FROM quads WHERE {COMPLETE})"),
        """SELECT count(*) AS held_out, CAST(sum("ParadoxLabel") AS BIGINT) AS positives, true AS bounded, true AS votes_follow,
        true AS better_than_chance FROM split WHERE is_test"""),
    # checks
    "quality_report": with_(ROLES + "," + STAGES.split(SCORED)[1].lstrip(" ,\n") + """,
        ends AS (SELECT arg_max("DevType", "AvgTrustScore") AS hk, max("AvgTrustScore") AS hv, arg_min("DevType", "AvgTrustScore") AS lk, min("AvgTrustScore") AS lv FROM roles),
        bounds AS (SELECT min(least("UsageScore", "TrustScore", "FrustrationScore")) AS lo, max(greatest("UsageScore", "TrustScore", "FrustrationScore")) AS hi FROM scored),
        rng AS (SELECT max("AvgTrustScore") - min("AvgTrustScore") AS w FROM stages WHERE "ExperienceGroup" <> 'Unknown'),
        checks AS (
          SELECT 'row count' AS name, count(*) > 100 AS passed, 'rows=' || count(*) AS detail FROM scored
          UNION ALL SELECT 'required columns', false, 'missing: stages: Median'
          UNION ALL SELECT 'score bounds', lo >= 0 AND hi <= 100, printf('min=%.1f, max=%.1f', lo, hi) FROM bounds
          UNION ALL SELECT 'group ordering', hk = 'Student' AND lk = 'Data engineer', printf('highest=%.1f %s; lowest=%.1f %s', hv, hk, lv, lk) FROM ends
          UNION ALL SELECT 'group spread', w < 50, printf('range=%.2f', w) FROM rng
          UNION ALL SELECT 'output artefacts', true, 'missing: none')""",
        """SELECT * FROM checks UNION ALL SELECT 'ALL', bool_and(passed), count(*) FILTER (passed) || ' of ' || count(*) || ' passed' FROM checks"""),
}
ORACLE |= {f"row_slice_{name}": ORACLE[f"filtered_{name}"] for name in ("kpis", "quadrants", "top_countries")}
ORACLE |= {
    "quality_report_scanned": ORACLE["quality_report"],
    "version_roundtrip": """SELECT count(*) AS "read", CAST(sum(o_custkey) AS BIGINT) AS customers, count(*) AS n, round(min(o_totalprice), 6) AS lowest,
        round(max(o_totalprice), 6) AS highest, 2::BIGINT AS version FROM orders WHERE o_orderkey % 2 = 0""",
}
