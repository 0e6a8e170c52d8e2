"""SQL over the same tables, written independently of the Spark plans.

Ranks come from window functions, probabilities from closed forms or Simpson sums,
texts from pattern functions. Only constants are shared with the operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from guestlens import catalog as c
from guestlens.functions import labels, normal, text
from guestlens.functions.seed_texts import SEED_TEXTS
from guestlens.operators import aspects, language
from guestlens.schemas import SCORE_BAND_COLUMNS, TRAVELER_COUNT_COLUMNS

SPACE = text.SPACE_CLASS
WORD = text.WORD_PATTERN


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values: Sequence[str]) -> str:
    return ", ".join(quoted(v) for v in values)


def stripped(column: str) -> str:
    return f"regexp_replace({column}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def tokens(column: str) -> str:
    return f"regexp_extract_all(lower({column}), '{WORD}')"


def even(expr: str, digits: int = c.DIGITS) -> str:
    return f"round_even(({expr})::DOUBLE * 1e{digits}, 0) / 1e{digits}"


def mapped(column: str, table: dict[str, str], miss: str) -> str:
    whens = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in table.items())
    return f"CASE {column} {whens} ELSE {miss} END"


def simpson(density: str, low: str, high: str, steps: int = 4000) -> str:
    """Integral of ``density`` (in x) as a scalar subquery; the limits may use outer columns."""
    return (
        f"(SELECT (({high}) - ({low})) / {3 * steps} * sum(weight * ({density})) FROM ("
        f"SELECT CASE WHEN i IN (0, {steps}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS weight, "
        f"({low}) + (({high}) - ({low})) * i / {steps} AS x FROM range(0, {steps + 1}) r(i)))"
    )


def normal_upper(z: str) -> str:
    return simpson("exp(-x * x / 2) / sqrt(2 * pi())", z, f"({z}) + 12")


def t_both(t: str, df: str) -> str:
    density = (
        f"exp(lgamma((({df}) + 1) / 2.0) - lgamma(({df}) / 2.0)) / sqrt(({df}) * pi()) "
        f"* pow(1 + x * x / ({df}), -((({df}) + 1) / 2.0))"
    )
    return f"(1 - 2 * {simpson(density, '0', f'abs({t})')})"


def f_upper(f: str, d1: str, d2: str) -> str:
    density = (
        f"exp(lgamma((({d1}) + ({d2})) / 2.0) - lgamma(({d1}) / 2.0) - lgamma(({d2}) / 2.0) + ({d1}) / 2.0 * ln(({d1}) / ({d2})::DOUBLE) "
        f"+ (({d1}) / 2.0 - 1) * ln(greatest(x, 1e-300)) - (({d1}) + ({d2})) / 2.0 * ln(1 + ({d1}) * x / ({d2})))"
    )
    return f"(1 - {simpson(density, '0', f)})"


def normal_cdf(x: str) -> str:
    """Hart's rational approximation as published by West (2005); good to 1e-15 within seven deviations."""
    z = f"abs({x})"
    top = horner(
        (220.206867912376, 221.213596169931, 112.079291497871, 33.912866078383, 6.37396220353165, 0.700383064443688,
         3.52624965998911e-2), z,
    )
    bottom = horner(
        (440.413735824752, 793.826512519948, 637.333633378831, 296.564248779674, 86.7807322029461, 16.064177579207,
         1.75566716318264, 8.83883476483184e-2), z,
    )
    tail = f"CASE WHEN {z} > 7 THEN 0 ELSE exp(-({x}) * ({x}) / 2) * {top} / {bottom} END"
    return f"CASE WHEN ({x}) > 0 THEN 1 - ({tail}) ELSE {tail} END"


def chi2_even(h: str, df: int) -> str:
    """Upper tail for an even number of degrees of freedom."""
    terms = ["1"]
    factorial = 1
    for j in range(1, df // 2):
        factorial *= j
        terms.append(f"pow(({h}) / 2, {j}) / {factorial}")
    return f"exp(-({h}) / 2) * ({' + '.join(terms)})"


# ------------------------------------------------------------------ inputs

ORDER_ORIGIN = """
origin_orders AS (
  SELECT o.*, cu.c_mktsegment, CASE WHEN r_name = 'EUROPE' THEN 'Europe' ELSE 'Other' END AS origin
  FROM orders o JOIN customer cu ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def category_case(column: str, keywords: dict[str, Sequence[str]]) -> str:
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains({column}, {quoted(k)})" for k in ks) + f" THEN {quoted(name)}"
        for name, ks in keywords.items()
    )
    return f"CASE {whens} ELSE 'OTHER' END"


MENTIONS = f"""
mentions AS (
  SELECT *, {mapped("aspect_category", labels.CATEGORY_NAMES, "NULL")} AS category_name FROM (
    SELECT l_orderkey AS source_id, l_linenumber AS hotel_stars, lower(p_name) AS extracted_aspect,
           CASE l_returnflag WHEN 'R' THEN 'NEGATIVE' WHEN 'A' THEN 'NEUTRAL' ELSE 'POSITIVE' END AS sentiment,
           {category_case("lower(p_name)", c.PART_KEYWORDS)} AS aspect_category
    FROM lineitem JOIN part ON l_partkey = p_partkey))"""

DATED_ORDERS = """
dated AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'sometime' ELSE strftime(o_orderdate, '%B %Y') END AS stay_date,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS rating_score
  FROM orders)"""
IN_PERIOD = "try_strptime('1 ' || stay_date, '%d %B %Y') BETWEEN TIMESTAMP '1994-01-01' AND TIMESTAMP '1997-05-31'"

DOCUMENT_ASPECTS = f"""
doc_words AS (SELECT doc_id, {tokens("text")} AS ws FROM documents),
tok AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM doc_words),
opinion AS (
  SELECT t.doc_id, t.i, (CASE WHEN t.w IN ({listed(c.GOOD)}) THEN 1 ELSE -1 END)
         * (CASE WHEN p.w IN ({listed(c.NOT)}) THEN -1 ELSE 1 END) AS score
  FROM tok t LEFT JOIN tok p ON p.doc_id = t.doc_id AND p.i = t.i - 1
  WHERE t.w IN ({listed(c.GOOD)}) OR t.w IN ({listed(c.BAD)})),
hits AS (SELECT doc_id, i, w FROM tok WHERE w IN ({listed(c.TERMS)})),
aspects AS (
  SELECT h.doc_id, h.i, h.w AS extracted_aspect,
         CASE WHEN coalesce(sum(o.score), 0) > 0 THEN 'POSITIVE' WHEN coalesce(sum(o.score), 0) < 0 THEN 'NEGATIVE'
              ELSE 'NEUTRAL' END AS sentiment
  FROM hits h LEFT JOIN opinion o ON o.doc_id = h.doc_id AND o.i BETWEEN h.i - 3 AND h.i + 3
  GROUP BY h.doc_id, h.i, h.w)"""

BIGRAMS = f"""{DOCUMENT_ASPECTS},
pairs AS (
  SELECT a.doc_id, a.i AS hit, a.extracted_aspect, {category_case("a.extracted_aspect", c.DOCUMENT_KEYWORDS)} AS aspect_category,
         {mapped("t.w", labels.WORD_TRANSLATIONS, "t.w")} || '-' || {mapped("n.w", labels.WORD_TRANSLATIONS, "n.w")} AS bigram
  FROM aspects a JOIN tok t ON t.doc_id = a.doc_id JOIN tok n ON n.doc_id = t.doc_id AND n.i = t.i + 1
  WHERE (t.w = a.extracted_aspect OR n.w = a.extracted_aspect)
    AND t.w NOT IN ({listed(labels.BIGRAM_STOP_WORDS)}) AND n.w NOT IN ({listed(labels.BIGRAM_STOP_WORDS)}))"""


# ------------------------------------------------------------------ statistics


def summary(source: str, value: str, keys: str = "") -> str:
    group = f"{keys}, " if keys else ""
    tail = f" GROUP BY {keys}" if keys else ""
    return (
        f"SELECT {group}count({value}) AS n, {even(f'avg({value})')} AS mean, {even(f'median({value})')} AS median, "
        f"{even(f'stddev_samp({value})')} AS std, {even(f'min({value})')} AS min, {even(f'max({value})')} AS max FROM {source}{tail}"
    )


def ranked(source: str, value: str, group: str, levels: Sequence) -> str:
    """CTEs ``ranked`` (g, v, r, t) and ``sums`` (g, n, rank_sum), ``tot`` (n, k, ties)."""
    inside = ", ".join(quoted(x) if isinstance(x, str) else str(x) for x in levels)
    return f"""
ranked AS (
  SELECT {group} AS g, {value} AS v, rank() OVER (ORDER BY {value}) + (count(*) OVER (PARTITION BY {value}) - 1) / 2.0 AS r,
         count(*) OVER (PARTITION BY {value}) AS t
  FROM {source} WHERE {group} IN ({inside}) AND {value} IS NOT NULL),
sums AS (SELECT g, count(*) AS n, sum(r)::DOUBLE AS rank_sum FROM ranked GROUP BY g),
tot AS (SELECT (SELECT count(*) FROM ranked) AS n, (SELECT count(*) FROM sums) AS k,
               (SELECT sum(t * t - 1)::DOUBLE FROM ranked) AS ties),
kw AS (
  SELECT tot.n AS n, k, k - 1 AS df,
         (12.0 / (tot.n * (tot.n + 1.0)) * (SELECT sum(rank_sum * rank_sum / n) FROM sums) - 3 * (tot.n + 1))
         / (1 - ties / (tot.n::DOUBLE * tot.n * tot.n - tot.n)) AS h FROM tot)"""


def kruskal(source: str, value: str, group: str, levels: Sequence, prefix: str = "") -> str:
    df = len(levels) - 1
    return (
        f"WITH {prefix}{ranked(source, value, group, levels)} SELECT n, k, df, round(h, 6) AS statistic, "
        f"round({chi2_even('h', df)}, 6) AS p_value FROM kw"
    )


def main_row(problem: str, test: str, label: str, statistic: str, p: str, source: str) -> str:
    return (
        f"SELECT '{problem}' AS research_problem, '{test}' AS test, {even('s')} AS statistic, '{label}' AS statistic_label, "
        f"{even('p')} AS p_value, CASE WHEN p < 0.05 THEN 'Reject H₀ (p < 0.05)' ELSE 'Fail to reject H₀ (p ≥ 0.05)' END AS decision "
        f"FROM (SELECT {statistic} AS s, {p} AS p FROM {source})"
    )


def kruskal_main(problem: str, source: str, value: str, group: str, levels: Sequence, prefix: str = "") -> str:
    return f"WITH {prefix}{ranked(source, value, group, levels)} " + main_row(
        problem, "Kruskal-Wallis", "H", "h", chi2_even("h", len(levels) - 1), "kw"
    )


def mann_whitney(source: str, value: str, group: str, first: str, second: str, prefix: str = "") -> str:
    return f"""WITH {prefix}{ranked(source, value, group, (first, second))},
parts AS (
  SELECT a.n AS n1, b.n AS n2, a.rank_sum - a.n * (a.n + 1) / 2.0 AS u, tot.n AS n, ties
  FROM sums a, sums b, tot WHERE a.g = '{first}' AND b.g = '{second}'),
mwu AS (
  SELECT n1, n2, u, (greatest(u, n1 * n2 - u) - n1 * n2 / 2.0 - 0.5)
         / sqrt(n1 * n2 / 12.0 * (n + 1 - ties / (n * (n - 1.0)))) AS z FROM parts)"""


def dunn(source: str, value: str, group: str, levels: Sequence) -> str:
    return f"""{ranked(source, value, group, levels)},
pairs AS (
  SELECT a.g AS group1, b.g AS group2, a.n AS n1, b.n AS n2, a.rank_sum / a.n AS m1, b.rank_sum / b.n AS m2,
         abs(a.rank_sum / a.n - b.rank_sum / b.n)
         / sqrt((tot.n * (tot.n + 1.0) / 12 - ties / (12.0 * (tot.n - 1))) * (1.0 / a.n + 1.0 / b.n)) AS z, k
  FROM sums a JOIN sums b ON a.g < b.g, tot),
dunn AS (SELECT *, least(1, k * (k - 1) / 2 * 2 * {normal_upper("z")}) AS p FROM pairs)"""


def anova(source: str, value: str, group: str) -> str:
    return f"""
m AS (SELECT {group} AS g, count({value}) AS n, avg({value}) AS mean, var_samp({value}) AS v FROM {source} GROUP BY {group}),
grand AS (SELECT sum(n) AS n, count(*) AS k, sum(n * mean) / sum(n) AS mean FROM m),
f AS (
  SELECT grand.n::BIGINT AS n, k, k - 1 AS df1, (grand.n - k)::BIGINT AS df2,
         ((SELECT sum(m.n * pow(m.mean - grand.mean, 2)) FROM m) / (k - 1))
         / ((SELECT sum((n - 1) * v) FROM m) / (grand.n - k)) AS f FROM grand)
SELECT n, k, df1, df2, round(f, 6) AS statistic, round({f_upper("f", "df1", "df2")}, 6) AS p_value FROM f"""


def t_test(pooled: bool) -> str:
    if pooled:
        variance, df, name = "((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)", "n1 + n2 - 2", "student"
    else:
        variance, name = "v1 / n1 + v2 / n2", "welch"
        df = "pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1))"
    return f"""WITH s AS (
  SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS n1, count(*) FILTER (WHERE o_orderstatus = 'O') AS n2,
         avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS m1, avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS m2,
         var_samp(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS v1, var_samp(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS v2
  FROM orders),
t AS (SELECT n1, n2, (m1 - m2) / sqrt({variance}) AS t, ({df})::DOUBLE AS df FROM s)
SELECT n1, n2, round(t, 6) AS statistic, round(df, 6) AS df, '{name}' AS variant, round({t_both("t", "df")}, 6) AS p_value FROM t"""


def horner(coefficients: Sequence[float], x: str) -> str:
    out = f"{coefficients[-1]!r}::DOUBLE"
    for value in reversed(coefficients[:-1]):
        out = f"({out} * {x} + {value!r}::DOUBLE)"
    return out


def quantile_sql(p: str) -> str:
    """Inverse normal, with the published constants."""

    def ratio(table, x):
        return f"{horner(table[0], x)} / {horner(table[1], x)}"

    r = f"sqrt(-ln(least({p}, 1 - {p})))"
    return (
        f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * {ratio(normal.CENTRAL, f'(0.180625 - ({p} - 0.5) * ({p} - 0.5))')} "
        f"WHEN {r} <= 5 THEN sign({p} - 0.5) * {ratio(normal.MIDDLE, f'({r} - 1.6)')} "
        f"ELSE sign({p} - 0.5) * {ratio(normal.OUTER, f'({r} - 5)')} END"
    )


def shapiro() -> str:
    """W by listing every rank; p by the published transform for groups above eleven."""
    last = horner((0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056), "(1 / sqrt(n))")
    after = horner((0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633), "(1 / sqrt(n))")
    mean = horner((-1.5861, -0.31082, -0.083751, 0.0038915), "ln(n)")
    spread = horner((-0.4803, -0.082676, 0.0030302), "ln(n)")
    return f"""WITH places AS (
  SELECT event_type AS g, value AS x, row_number() OVER (PARTITION BY event_type ORDER BY value) AS i,
         count(*) OVER (PARTITION BY event_type) AS n FROM events),
shares AS (SELECT *, (i - 0.375::DOUBLE) / (n + 0.25::DOUBLE) AS p FROM places),
scores AS (SELECT g, x, i, n, {quantile_sql("p")} AS m FROM shares),
ends AS (
  SELECT g, max(n) AS n, sum(m * m) AS mm, max(m) FILTER (WHERE i = n) AS m1, max(m) FILTER (WHERE i = n - 1) AS m2 FROM scores GROUP BY g),
weights AS (SELECT *, {last} + m1 / sqrt(mm) AS w1, {after} + m2 / sqrt(mm) AS w2 FROM ends),
scaled AS (SELECT *, sqrt((mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * w1 * w1 - 2 * w2 * w2)) AS f FROM weights),
w AS (
  SELECT s.g, max(c.n) AS n, pow(sum(s.x * CASE WHEN i = 1 THEN -w1 WHEN i = 2 THEN -w2 WHEN i = c.n - 1 THEN w2
         WHEN i = c.n THEN w1 ELSE m / f END), 2) / (var_samp(s.x) * (max(c.n) - 1)) AS w FROM scores s JOIN scaled c ON s.g = c.g GROUP BY s.g),
z AS (SELECT g, n, w, (ln(1 - w) - {mean}) / exp({spread}) AS z FROM w),
p AS (SELECT *, {normal_upper("z")} AS p FROM z)
SELECT g AS event_type, n, round(w, 6) AS w, round(p, 6) AS p_value, CASE WHEN p > 0.05 THEN 'Yes' ELSE 'No' END AS normal,
       n <= 5000 AS p_reliable FROM p"""


def letter_words(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{M}}]+'), lambda w: w <> '')"


def word_grams(source: str, *keys: str) -> str:
    """Grams of the column ``word``, with repeats, beside the keys."""
    kept = "".join(f"{k}, " for k in keys)
    parts = [f"SELECT {kept}1 AS size, unnest(list_transform(range(1, length(word) + 1), lambda i: substr(word, i, 1))) AS gram FROM {source}"]
    parts += [
        f"SELECT {kept}{n}, unnest(list_transform(range(1, length(word) + {4 - n}), lambda i: substr(' ' || word || ' ', i, {n}))) FROM {source}" for n in (2, 3)
    ]
    return " UNION ALL ".join(parts)


def gram_counts(texts: str, size: int) -> str:
    """CTEs that count the grams of ``texts`` (language, text) as ``kept`` (language, size, gram, n)."""
    return f"""tw AS (SELECT language, word, count(*) AS times FROM (SELECT language, unnest({letter_words("text")}) AS word FROM {texts}) GROUP BY ALL),
tg AS ({word_grams("tw", "language", "times")}),
tc AS (SELECT language, size, gram, sum(times)::BIGINT AS n FROM tg GROUP BY ALL),
kept AS (SELECT language, size, gram, n FROM tc QUALIFY row_number() OVER (PARTITION BY language, size ORDER BY n DESC, gram) <= {size})"""


def languages_found(texts: str, size: int) -> str:
    """CTEs up to ``named`` (doc_id, lang, language): documents scored by the grams of ``texts``.

    What all unknown grams cost is the same for every language, so only what a known gram adds is summed.
    """
    return f"""{gram_counts(texts, size)},
kinds AS (SELECT size, count(DISTINCT gram) AS kinds FROM kept GROUP BY size),
totals AS (SELECT language, size, sum(n) AS total FROM kept GROUP BY ALL),
gains AS (SELECT language, size, gram, round(1000 * ln(0.95::DOUBLE * (n / total) + 0.05::DOUBLE / kinds)) - round(1000 * ln(0.05::DOUBLE / kinds)) AS gain
  FROM kept JOIN kinds USING (size) JOIN totals USING (language, size)),
dw AS (SELECT doc_id, word, count(*) AS times FROM (SELECT doc_id, unnest({letter_words("text")}) AS word FROM documents) GROUP BY ALL),
words AS (SELECT DISTINCT word FROM dw),
wg AS ({word_grams("words", "word")}),
gc AS (SELECT word, size, gram, count(*) AS times FROM wg GROUP BY ALL),
ws AS (SELECT word, language, sum(times * gain) AS score FROM gc JOIN gains USING (size, gram) GROUP BY ALL),
ds AS (SELECT doc_id, language, sum(times * score) AS score FROM dw JOIN ws USING (word) GROUP BY ALL),
best AS (SELECT doc_id, language FROM ds QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, language) = 1),
named AS (SELECT d.doc_id, d.lang, d.text, CASE WHEN b.language IS NOT NULL THEN b.language WHEN s.doc_id IS NOT NULL THEN 'other' END AS language
  FROM documents d LEFT JOIN best b ON b.doc_id = d.doc_id LEFT JOIN (SELECT DISTINCT doc_id FROM dw) s ON s.doc_id = d.doc_id)"""


def built_in_languages() -> str:
    rows = ", ".join(f"('{code}', '{text.replace(chr(39), chr(39) * 2)}')" for code, text in SEED_TEXTS.items())
    return f"WITH seeds(language, text) AS (VALUES {rows}), {languages_found('seeds', language.PROFILE_SIZE)}"


LANGUAGE_ACCURACY = """SELECT lang, count(*) AS texts, count(*) FILTER (WHERE language = lang) AS hits, count(*) FILTER (WHERE language IS NULL) AS undetected,
  round(count(*) FILTER (WHERE language = lang) / nullif(count(language), 0), 6) AS share FROM named WHERE lang IS NOT NULL GROUP BY lang"""


def band_case(score: str) -> str:
    return (
        f"CASE WHEN {score} >= 9 THEN 'wonderful_9plus' WHEN {score} >= 7 THEN 'good_7to9' WHEN {score} >= 5 THEN 'fair_5to7' "
        f"WHEN {score} >= 3 THEN 'poor_3to5' WHEN {score} >= 1 THEN 'very_poor_1to3' END"
    )


def unescaped(column: str) -> str:
    out = f"regexp_replace({column}, '(?s)<[^>]*>', '', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{char}')"
    return stripped(out)


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    sql: dict[str, str] = {}

    # cleaning
    sql["union_passes"] = """
SELECT o_orderkey, o_orderpriority AS traveler_type, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_orderpriority, NULL, o_orderstatus FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey, 'Business', NULL, o_orderstatus FROM orders WHERE o_orderstatus = 'P'"""
    sql["month_parse_filter"] = f"""WITH {DATED_ORDERS}
SELECT o_orderkey, stay_date, strftime(try_strptime('1 ' || stay_date, '%d %B %Y'), '%Y-%m-%d') AS month
FROM dated WHERE {IN_PERIOD} AND rating_score IS NOT NULL"""
    sql["text_min_words"] = f"""
SELECT doc_id, len(regexp_split_to_array(t, '{SPACE}+'))::INTEGER AS words, md5(t) AS text_md5
FROM (SELECT doc_id, {stripped("text")} AS t FROM documents)
WHERE t <> '' AND len(regexp_split_to_array(t, '{SPACE}+')) > 2"""
    sql["nonempty_comment"] = f"""
SELECT doc_id FROM documents WHERE lang IN ('en', 'de') AND {stripped("text")} <> ''"""
    sql["stage_counts"] = f"""WITH {DATED_ORDERS},
flagged AS (SELECT *, coalesce({IN_PERIOD}, false) AS ok FROM dated)
SELECT 0 AS position, 'loaded' AS stage, count(*) AS rows FROM flagged
UNION ALL SELECT 1, 'in_period', count(*) FROM flagged WHERE ok
UNION ALL SELECT 2, 'with_score', count(*) FROM flagged WHERE ok AND rating_score IS NOT NULL
UNION ALL SELECT 3, 'distinct_content', count(*) FROM (
  SELECT DISTINCT o_custkey, stay_date, o_orderstatus FROM flagged WHERE ok AND rating_score IS NOT NULL)"""
    long = f"len(regexp_extract_all(coalesce(text, ''), '[^[:space:]]+')) >= 3"
    sql["text_stage_counts"] = f"""{built_in_languages()}
SELECT 0 AS position, 'loaded' AS stage, count(*) AS rows FROM documents
UNION ALL SELECT 1, 'with_text', count(*) FROM documents WHERE {stripped("text")} <> ''
UNION ALL SELECT 2, 'enough_words', count(*) FROM documents WHERE {long}
UNION ALL SELECT 3, 'in_language', count(*) FROM named WHERE {long} AND coalesce(language, 'en') = 'en'"""
    sql["business_only"] = """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN ' Business' || chr(9) ELSE 'business' END AS traveler_type
FROM orders WHERE o_orderstatus IN ('F', 'P')"""
    sql["canonical_category"] = """
SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Solo' WHEN 'BUILDING' THEN 'Business' WHEN 'FURNITURE' THEN 'Family'
       ELSE 'Group of friends' END AS traveler_type FROM customer"""
    sql["origin_binary"] = """
SELECT c_custkey, coalesce(lower(n_name), 'Unknown') AS country, CASE WHEN n_name = 'NATION_7' THEN 'Nation_7' ELSE 'Other' END AS origin
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""
    sql["parse_score"] = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN 0.0::DOUBLE
       ELSE (l_quantity::INTEGER::VARCHAR || '.' || l_linenumber::VARCHAR)::DOUBLE END AS score FROM lineitem"""
    sql["review_key"] = """
SELECT p_partkey, md5(p_brand || '|' || p_name || '|' || CASE WHEN p_type = 'SMALL' THEN '' ELSE p_type END) AS source_id FROM part"""
    sql["score_band_filter"] = f"""
SELECT l_orderkey, l_linenumber, score, band FROM (
  SELECT l_orderkey, l_linenumber, l_quantity / 5 AS score, {band_case("l_quantity / 5")} AS band FROM lineitem)
WHERE band IN ('fair_5to7', 'poor_3to5', 'very_poor_1to3')"""
    sql["label_translate"] = """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Budowa' WHEN 'MACHINERY' THEN 'Maszyny' ELSE c_mktsegment END AS kept,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Budowa' WHEN 'MACHINERY' THEN 'Maszyny' END AS mapped FROM customer"""

    # keep-first and takes
    sql["dedup_keep_first"] = """
SELECT doc_id AS source_id, lang AS hotel_name, source AS traveler_type FROM (
  SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, text ORDER BY source ASC NULLS LAST, doc_id) AS place
  FROM (SELECT doc_id, lang, text, nullif(source, 'src1') AS source FROM documents)) WHERE place = 1"""
    sql["dedup_by_key"] = """
SELECT doc_id, source, lang, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS place FROM documents) WHERE place = 1"""
    sql["dedup_across_batches"] = """
SELECT doc_id, band::INTEGER AS band FROM (
  SELECT doc_id, length(source) AS band, min(length(source)) OVER (PARTITION BY text) AS first_band FROM documents) WHERE band = first_band"""
    sql["dedup_incremental"] = sql["dedup_across_batches"]
    sql["take_per_group"] = """
SELECT o_custkey, o_orderkey FROM (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS place FROM orders)
WHERE place <= 5"""
    sql["take_whole_pages"] = """WITH paged AS (
  SELECT o_custkey, o_orderkey, (9999 - year(o_orderdate)) * 4 - quarter(o_orderdate) AS page FROM orders),
counted AS (SELECT o_custkey, page, count(*) AS n FROM paged GROUP BY ALL),
summed AS (SELECT *, sum(n) OVER (PARTITION BY o_custkey ORDER BY page) - n AS earlier FROM counted)
SELECT p.o_custkey, p.o_orderkey, p.page::INTEGER AS page FROM paged p JOIN summed s ON p.o_custkey = s.o_custkey AND p.page = s.page WHERE earlier < 4"""
    sql["min_group_size"] = """
SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE n >= 12"""

    # descriptives
    sql["describe_overall"] = f"""WITH s AS ({summary("lineitem", "l_quantity")})
SELECT 0 AS position, 'N' AS statistic, n::DOUBLE AS value FROM s UNION ALL SELECT 1, 'Mean', mean FROM s
UNION ALL SELECT 2, 'Median', median FROM s UNION ALL SELECT 3, 'Std Dev', std FROM s
UNION ALL SELECT 4, 'Min', min FROM s UNION ALL SELECT 5, 'Max', max FROM s"""
    sql["describe_overall_wide"] = f"""
SELECT n::DOUBLE AS N, mean AS Mean, median AS Median, std AS Std, min AS Min, max AS Max FROM ({summary("events", "value")})"""
    sql["describe_by_group"] = f"SELECT l_returnflag, n, mean, median, std FROM ({summary('lineitem', 'l_quantity', 'l_returnflag')})"
    sql["describe_by_group5"] = f"SELECT event_type, n, mean, median, std FROM ({summary('events', 'value', 'event_type')})"
    sql["describe_by_origin"] = (
        f"WITH {ORDER_ORIGIN} SELECT origin, n, mean, median, std FROM ({summary('origin_orders', 'o_totalprice', 'origin')})"
    )
    sql["descriptive_report"] = f"""WITH {ORDER_ORIGIN},
sets AS (
  SELECT o_orderstatus, o_orderpriority, origin, grouping(o_orderstatus, o_orderpriority, origin) AS g,
         count(*) AS n, avg(o_totalprice) AS mean, median(o_totalprice) AS median, stddev_samp(o_totalprice) AS std
  FROM origin_orders GROUP BY GROUPING SETS ((), (o_orderstatus), (o_orderpriority), (origin)))
SELECT CASE g WHEN 7 THEN 0 WHEN 3 THEN 1 WHEN 5 THEN 2 ELSE 3 END AS position,
       CASE g WHEN 7 THEN 'OGÓŁEM' WHEN 3 THEN 'Standard Hotelu' WHEN 5 THEN 'Profil Podróżnego' ELSE 'Pochodzenie' END AS kategoria,
       CASE g WHEN 7 THEN 'Cała próba' WHEN 3 THEN o_orderstatus WHEN 5 THEN o_orderpriority
              ELSE replace(origin, 'Other', 'Reszta Świata') END AS podgrupa,
       n AS liczba_opinii, {even("mean")} AS srednia, {even("median")} AS mediana, {even("std")} AS odch_stand FROM sets"""
    sql["report_rounding"] = """
SELECT l_orderkey, l_linenumber, round_even((l_quantity + l_linenumber * 0.005::DOUBLE) * 100, 0) / 100 AS shown FROM lineitem"""
    sql["histogram"] = """WITH e AS (SELECT min(value) AS low, (max(value) - min(value)) / 20 AS width, avg(value) AS mean FROM events),
bins AS (SELECT i AS bin, low + i * width AS lower, low + (i + 1) * width AS upper, mean FROM e, range(0, 20) r(i))
SELECT bin::INTEGER AS bin, round(lower, 6) AS lower, round(upper, 6) AS upper,
       (SELECT count(*) FROM events WHERE value >= lower AND (value < upper OR bin = 19)) AS rows, round(mean, 6) AS mean FROM bins"""
    sql["boxplot_stats"] = """WITH b AS (
  SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
  FROM events GROUP BY event_type)
SELECT e.event_type, count(*) AS n, round(max(q1), 6) AS q1, round(max(median), 6) AS median, round(max(q3), 6) AS q3,
       round(min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
       round(max(value) FILTER (WHERE value <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
       count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers
FROM events e JOIN b ON e.event_type = b.event_type GROUP BY e.event_type"""
    rates = """WITH r AS (
  SELECT s_nationkey, count(*) AS total, count(*) FILTER (WHERE l_returnflag = 'R') AS negative
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_suppkey, s_nationkey)"""
    sql["negative_rate"] = f"{rates} SELECT s_nationkey, round(avg(negative / total * 100), 6) AS negative_rate FROM r GROUP BY s_nationkey"
    sql["negative_rate_pooled"] = (
        f"{rates} SELECT s_nationkey, round(sum(negative) / sum(total) * 100, 6) AS negative_rate FROM r GROUP BY s_nationkey"
    )
    sql["language_structure"] = """WITH wanted(code, language) AS (
  VALUES ('pl', 'Polski'), ('en', 'Angielski'), ('de', 'Niemiecki'), ('cs', 'Czeski'), ('Inne', 'Inne')),
n AS (
  SELECT w.code, language, (SELECT count(*) FROM documents d WHERE
    CASE WHEN d.lang IN ('pl', 'en', 'de', 'cs') THEN d.lang ELSE 'Inne' END = w.code) AS reviews FROM wanted w)
SELECT row_number() OVER (ORDER BY code = 'Inne', reviews DESC, code)::INTEGER AS position, code, language, reviews,
       round(reviews * 100.0 / sum(reviews) OVER (), 4) AS share FROM n"""
    bands = ", ".join(f"count(*) FILTER (WHERE band = '{b}') AS {b}" for b in SCORE_BAND_COLUMNS)
    sql["score_distribution"] = f"""WITH l AS (SELECT *, {band_case("l_quantity / 5")} AS band FROM lineitem),
langs AS (
  SELECT l_suppkey, '{{' || string_agg('"' || l_linestatus || '":' || n, ',' ORDER BY l_linestatus) || '}}' AS languages_json
  FROM (SELECT l_suppkey, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY l_suppkey)
SELECT l.l_suppkey, count(*) AS total, {bands},
       count(*) FILTER (WHERE band IN ('fair_5to7', 'poor_3to5', 'very_poor_1to3')) AS negative_total,
       count(*) FILTER (WHERE l_returnflag = 'A') AS type_families, count(*) FILTER (WHERE l_returnflag = 'N') AS type_couples,
       max(languages_json) AS languages_json FROM l JOIN langs ON l.l_suppkey = langs.l_suppkey GROUP BY l.l_suppkey"""
    zeros = ", ".join(f"0::BIGINT AS {t}" for t in TRAVELER_COUNT_COLUMNS[1:])
    sql["distribution_rows"] = f"""
SELECT o_custkey, count(*) AS total, 0::BIGINT AS wonderful_9plus, 0::BIGINT AS good_7to9,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS fair_5to7, 0::BIGINT AS poor_3to5,
       count(*) FILTER (WHERE o_orderstatus = 'P') AS very_poor_1to3,
       count(*) FILTER (WHERE o_orderstatus IN ('F', 'P')) AS negative_total,
       count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS type_families, {zeros},
       CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'P') = 0 THEN '{{}}'
            ELSE '{{"pl":' || count(*) FILTER (WHERE o_orderstatus = 'P') || '}}' END AS languages_json FROM orders GROUP BY o_custkey"""

    # tests
    sql["mid_ranks"] = """
SELECT DISTINCT value, count(*) OVER (PARTITION BY value) AS n,
       (rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0)::DOUBLE AS mid_rank FROM events"""
    sql["shapiro_wilk"] = shapiro()
    sql["levene"] = f"""WITH med AS (SELECT o_orderpriority AS p, median(o_totalprice) AS med FROM orders GROUP BY 1),
z AS (SELECT o_orderpriority, abs(o_totalprice - med) AS d FROM orders JOIN med ON o_orderpriority = p),{anova("z", "d", "o_orderpriority")}"""
    sql["anova_oneway"] = f"WITH {anova('orders', 'o_totalprice', 'o_orderpriority')}"
    sql["kruskal_wallis"] = kruskal("lineitem", "l_quantity", "l_returnflag", c.FLAGS)
    sql["kruskal_wallis_events"] = kruskal("events", "value", "event_type", c.EVENT_TYPES)
    sql["mann_whitney_u"] = (
        mann_whitney("lineitem", "l_quantity", "l_linestatus", "F", "O")
        + f" SELECT n1, n2, u AS statistic, round(z, 6) AS z, 'asymptotic' AS method, round(least(1, 2 * {normal_upper('z')}), 6) AS p_value FROM mwu"
    )
    sql["ttest_ind"] = t_test(False)
    sql["ttest_student"] = t_test(True)
    sql["dunn_posthoc"] = f"""WITH {dunn("events", "value", "event_type", c.EVENT_TYPES)}
SELECT group1, group2, n1, n2, round(m1, 6) AS mean_rank1, round(m2, 6) AS mean_rank2, round(z, 6) AS z, round(p, 6) AS p_adjusted FROM dunn"""

    def cell(row: str, column: str) -> str:
        if row == column:
            return "1.0::DOUBLE"
        a, b = sorted((row, column))
        return f"(SELECT p FROM dunn WHERE group1 = '{a}' AND group2 = '{b}')"

    matrix = f"WITH {dunn('lineitem', 'l_quantity', 'l_returnflag', c.FLAGS)} "
    sql["dunn_matrix"] = matrix + " UNION ALL ".join(
        f"SELECT {i} AS position, '{x}' AS label, " + ", ".join(f"{even(cell(x, y))} AS {y}" for y in c.FLAGS)
        for i, x in enumerate(c.FLAGS, 1)
    )
    names = {"A": "Polska", "N": "N", "R": "Reszta Świata"}

    def shown(p: str) -> str:
        return f"CASE WHEN {p} >= 0.9999 THEN '1.000' WHEN {p} < 0.001 THEN '< 0.001' ELSE printf('%.4f', {p}) END"

    sql["dunn_report"] = matrix + " UNION ALL ".join(
        f"SELECT {i} AS position, '{names[x]}' AS label, "
        + ", ".join(f'{shown(even(cell(x, y), 4))} AS "{names[y]}"' for y in c.FLAGS)
        for i, x in enumerate(c.FLAGS, 1)
    )
    sql["tukey_hsd"] = """WITH m AS (
  SELECT o_orderpriority AS g, count(*) AS n, avg(o_totalprice) AS mean, var_samp(o_totalprice) AS v FROM orders GROUP BY 1),
s AS (SELECT count(*) AS k, (sum(n) - count(*))::BIGINT AS df, sum((n - 1) * v) / (sum(n) - count(*)) AS square FROM m)
SELECT a.g AS group1, b.g AS group2, round(b.mean - a.mean, 6) AS meandiff, round(sqrt(square / 2 * (1.0 / a.n + 1.0 / b.n)), 6) AS se,
       round(abs(b.mean - a.mean) / sqrt(square / 2 * (1.0 / a.n + 1.0 / b.n)), 6) AS q, k, df
FROM m a JOIN m b ON a.g < b.g, s"""
    weight = "CASE WHEN i IN (0, {n}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    sql["tukey_pvalues"] = f"""WITH m AS (
  SELECT o_orderpriority AS g, count(*) AS n, avg(o_totalprice) AS mean, var_samp(o_totalprice) AS v FROM orders GROUP BY 1),
t AS (SELECT count(*) AS k, (sum(n) - count(*))::DOUBLE AS df, sum((n - 1) * v) / (sum(n) - count(*)) AS square FROM m),
pairs AS (
  SELECT a.g AS group1, b.g AS group2, abs(b.mean - a.mean) / sqrt(square / 2 * (1.0 / a.n + 1.0 / b.n)) AS q, k, df
  FROM m a JOIN m b ON a.g < b.g, t),
spread AS (
  SELECT 1 - 8 / sqrt(2 * df) + 16 / sqrt(2 * df) * i / 80 AS s, 16 / sqrt(2 * df) / 240 * ({weight.format(n=80)}) AS w FROM t, range(0, 81) r(i)),
mass AS (SELECT s, w * exp(ln(2) + df / 2 * ln(df / 2) - lgamma(df / 2) + (df - 1) * ln(s) - df * s * s / 2) AS w FROM spread, t),
z AS (SELECT -7 + 14.0::DOUBLE * i / 400 AS z, 14.0::DOUBLE / 1200 * ({weight.format(n=400)}) AS w FROM range(0, 401) r(i)),
inner_z AS (SELECT z, w * exp(-z * z / 2) / sqrt(2 * pi()) AS w, {normal_cdf("z")} AS up FROM z),
cells AS (SELECT group1, group2, k, mass.w AS ws, inner_z.w AS wz, up, z - q * s AS low FROM pairs, mass, inner_z),
p AS (SELECT group1, group2, 1 - sum(ws * wz * k * pow(up - ({normal_cdf("low")}), k - 1)) AS p FROM cells GROUP BY group1, group2)
SELECT group1, group2, round(p, 6) AS p_adj, p < 0.05 AS reject FROM p"""
    sql["group_comparison"] = kruskal_main("events", "events", "value", "event_type", c.EVENT_TYPES)
    sql["pb1"] = kruskal_main("PB1", "lineitem", "l_quantity", "l_linenumber", (3, 4, 5))
    sql["pb2"] = kruskal_main("PB2", "origin_orders", "o_totalprice", "c_mktsegment", c.SEGMENTS, ORDER_ORIGIN + ",")
    sql["pb3"] = mann_whitney("origin_orders", "o_totalprice", "origin", "Europe", "Other", ORDER_ORIGIN + ",") + " " + main_row(
        "PB3", "Mann-Whitney U", "U", "u", f"least(1, 2 * {normal_upper('z')})", "mwu"
    )
    p = "CASE WHEN l_linenumber = 1 THEN l_quantity / 50 ELSE l_discount / 7 + l_tax / 3 END"
    sql["pvalue_format"] = f"""
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN 'p=' || l_linestatus ELSE {shown("p")} END AS shown,
       replace('Test: ' || l_linestatus || ' = ' || printf('%.2f', l_quantity)
         || CASE WHEN p >= 0.0001 THEN ', p = ' || printf('%.4f', p) ELSE ', p < 0.0001' END, '.', ',') AS note
FROM (SELECT *, {p} AS p FROM lineitem)"""

    # text
    labelled = "WITH labelled AS (SELECT lang AS language, text FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL), "
    sql["language_id"] = f"{built_in_languages()} SELECT doc_id, lang, language FROM named"
    sql["language_filter"] = f"{built_in_languages()} SELECT doc_id FROM named WHERE language IS NULL OR language = 'en'"
    sql["language_accuracy"] = f"{labelled}{languages_found('labelled', 2_000)} {LANGUAGE_ACCURACY}"
    sql["language_accuracy_built_in"] = f"{built_in_languages()} {LANGUAGE_ACCURACY}"
    sql["language_profiles"] = f"{labelled}{gram_counts('labelled', 2_000)} SELECT language, gram, n FROM kept"
    sql["aspect_extract"] = f"WITH {DOCUMENT_ASPECTS} SELECT doc_id, extracted_aspect, sentiment FROM aspects"
    stems, opinions = "|".join(sorted(aspects.phrase_terms())), listed((*aspects.POSITIVE_WORDS, *aspects.NEGATIVE_WORDS))
    compounds = listed(aspects.COMPOUND_WORDS)
    sql["aspect_phrases"] = f"""WITH w AS (SELECT doc_id, {tokens("text")} AS ws FROM documents),
tok AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM w),
thing AS (SELECT *, regexp_matches(w, '{stems}') AND w NOT IN ({opinions}) AS is_thing FROM tok),
part AS (SELECT *, is_thing OR (w IN ({compounds}) AND coalesce(lag(is_thing) OVER o, false)) AS is_part FROM thing WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
edge AS (SELECT *, is_thing AND NOT coalesce(lag(is_part) OVER o, false) AS begins FROM part WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
run AS (SELECT *, sum(begins::INTEGER) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM edge),
phrase AS (SELECT doc_id, run, min(i) AS i, string_agg(w, ' ' ORDER BY i) AS extracted_aspect FROM run WHERE is_part GROUP BY ALL),
opinion AS (SELECT t.doc_id, t.i, (CASE WHEN t.w IN ({listed(aspects.POSITIVE_WORDS)}) THEN 1 ELSE -1 END)
       * (CASE WHEN p.w IN ({listed(aspects.NEGATIONS)}) THEN -1 ELSE 1 END) AS score
  FROM tok t LEFT JOIN tok p ON p.doc_id = t.doc_id AND p.i = t.i - 1 WHERE t.w IN ({opinions}))
SELECT h.doc_id, extracted_aspect, CASE WHEN coalesce(sum(o.score), 0) > 0 THEN 'POSITIVE' WHEN coalesce(sum(o.score), 0) < 0 THEN 'NEGATIVE'
       ELSE 'NEUTRAL' END AS sentiment
FROM phrase h LEFT JOIN opinion o ON o.doc_id = h.doc_id AND o.i BETWEEN h.i - 3 AND h.i + 3 GROUP BY h.doc_id, h.run, extracted_aspect"""
    sql["flatten_aspects"] = f"""WITH t AS (SELECT doc_id, {tokens("text")} AS ws FROM documents),
l AS (SELECT doc_id, list_filter(ws, lambda w: length(w) = 9) AS a, list_filter(ws, lambda w: length(w) = 8) AS s FROM t),
i AS (SELECT doc_id, a, s, unnest(range(1, least(len(a), len(s)) + 1)) AS i FROM l)
SELECT doc_id, a[i] AS extracted_aspect, CASE WHEN s[i] < 'm' THEN 'NEGATIVE' ELSE 'POSITIVE' END AS sentiment FROM i"""
    sql["opinion_weights"] = f"""WITH w AS (SELECT quality, unnest({tokens("text")}) AS word FROM documents JOIN labels USING (doc_id) WHERE quality IN (0, 1)),
n AS (SELECT word, count(*) FILTER (WHERE quality = 1) AS positive, count(*) FILTER (WHERE quality = 0) AS negative FROM w GROUP BY word),
t AS (SELECT sum(positive) + 0.5::DOUBLE * count(*) AS good, sum(negative) + 0.5::DOUBLE * count(*) AS bad FROM n)
SELECT word, positive, negative, round(ln((positive + 0.5::DOUBLE) / good) - ln((negative + 0.5::DOUBLE) / bad), 6) AS weight FROM n, t WHERE positive + negative >= 5"""
    sql["aspect_category"] = f"""WITH w AS (SELECT unnest({tokens("text")}) AS extracted_aspect FROM documents),
n AS (SELECT extracted_aspect, count(*) AS n FROM w GROUP BY 1),
k AS (SELECT *, {category_case("extracted_aspect", labels.ASPECT_KEYWORDS)} AS aspect_category FROM n)
SELECT *, {mapped("aspect_category", labels.CATEGORY_NAMES, "NULL")} AS category_name FROM k"""
    sql["aspect_category_join"] = f"""
SELECT p_partkey, p_name AS extracted_aspect, {category_case("lower(p_name)", c.PART_KEYWORDS)} AS aspect_category FROM part"""
    sql["negative_aspects"] = f"""WITH {MENTIONS}
SELECT source_id, hotel_stars, extracted_aspect, sentiment, aspect_category FROM mentions
WHERE sentiment = 'NEGATIVE' AND aspect_category <> 'OTHER'"""
    counts = """SELECT category_name, count(*) FILTER (WHERE sentiment = 'NEGATIVE') AS "NEGATIVE",
  count(*) FILTER (WHERE sentiment = 'NEUTRAL') AS "NEUTRAL", count(*) FILTER (WHERE sentiment = 'POSITIVE') AS "POSITIVE"
  FROM mentions GROUP BY category_name"""
    sql["aspect_sentiment_crosstab"] = f"WITH {MENTIONS} {counts}"
    shares = ", ".join(
        f"round(count(*) FILTER (WHERE aspect_category = '{k}') * 100.0 / count(*), 6) AS {quoted_name(k)}" for k in c.PART_KEYWORDS
    )
    sql["crosstab_share"] = f"""WITH {MENTIONS}
SELECT hotel_stars, {shares} FROM mentions WHERE sentiment = 'NEGATIVE' AND aspect_category <> 'OTHER' GROUP BY hotel_stars"""
    sql["category_ranking"] = f"""WITH {MENTIONS}
SELECT category_name, count(*) AS mentions FROM mentions WHERE sentiment = 'NEGATIVE' AND aspect_category <> 'OTHER'
GROUP BY category_name ORDER BY mentions DESC, category_name"""
    sql["absa_report"] = f"""WITH {MENTIONS}
SELECT category_name AS kategoria_skargi, "NEGATIVE" AS sentyment_negatywny, "NEUTRAL" AS sentyment_neutralny,
       "POSITIVE" AS sentyment_pozytywny, "NEGATIVE" + "NEUTRAL" + "POSITIVE" AS laczna_liczba_aspektow FROM ({counts})
ORDER BY sentyment_negatywny DESC, kategoria_skargi"""
    sql["aspect_text_join"] = f"""WITH {DOCUMENT_ASPECTS}
SELECT a.doc_id, extracted_aspect, sentiment, md5(text) AS text_md5 FROM aspects a JOIN documents d ON a.doc_id = d.doc_id"""
    sql["aspect_bigrams"] = f"WITH {BIGRAMS} SELECT doc_id, extracted_aspect, bigram, count(*) AS n FROM pairs GROUP BY ALL"
    sql["top_bigrams"] = f"""WITH {BIGRAMS},
n AS (SELECT aspect_category, bigram, count(*) AS mentions FROM pairs GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY aspect_category ORDER BY mentions DESC, bigram)::INTEGER AS place FROM n)
SELECT aspect_category, bigram, mentions, place FROM r WHERE place <= 30"""

    # markup
    link = "<li><a href=\"([^\"]*)\">"
    label = "(?s)<li><a [^>]*>(.*?)</a>"
    sql["page_card_extract"] = f"""WITH p AS (
  SELECT page_id, regexp_extract_all(html, '{link}', 1) AS links, regexp_extract_all(html, '{label}', 1) AS labels FROM pages),
i AS (SELECT page_id, unnest(links) AS link, unnest(labels) AS label, unnest(range(0, len(links)))::INTEGER AS place FROM p)
SELECT page_id, place, {unescaped("link")} AS link, {unescaped("label")} AS label FROM i"""
    sql["review_card_extract"] = f"""
SELECT md5('Hotel ' || lang || '|guest & ' || doc_id || '|' || source) AS source_id, 'Hotel ' || lang AS hotel_name,
       'May 2025' AS stay_date, 0 AS hotel_stars, '' AS traveler_type, CASE WHEN lang = 'en' THEN 'en' ELSE 'Unknown' END AS reviewer_country,
       (n_chars || '.5')::DOUBLE AS rating_score, source AS title, '' AS pos_text, md5({stripped("text")}) AS neg_text
FROM documents WHERE {stripped("text")} <> ''
UNION ALL SELECT md5('Hotel ' || lang || '||again ' || doc_id), 'Hotel ' || lang, '', 0, 'Couple', 'Unknown', 0.0::DOUBLE,
       'again ' || doc_id, 'café ’' || source || '’' || chr(10) || 'ends', '' FROM documents"""
    sql["option_counts"] = """
SELECT l_suppkey, 'ALL' AS value, count(*) AS reviews FROM lineitem GROUP BY l_suppkey
UNION ALL SELECT l_suppkey, 'FAMILIES', count(*) FILTER (WHERE l_linestatus = 'F') FROM lineitem GROUP BY l_suppkey
UNION ALL SELECT l_suppkey, 'COUPLES', count(*) FILTER (WHERE l_linestatus = 'O') FROM lineitem GROUP BY l_suppkey"""
    sql["menu_distribution"] = """
SELECT l_suppkey, count(*) AS total, count(*) FILTER (WHERE l_returnflag = 'A') AS wonderful_9plus, 0::BIGINT AS good_7to9,
       count(*) FILTER (WHERE l_returnflag = 'N') AS fair_5to7, count(*) FILTER (WHERE l_returnflag = 'R') AS poor_3to5,
       0::BIGINT AS very_poor_1to3, count(*) FILTER (WHERE l_returnflag IN ('N', 'R')) AS negative_total,
       count(*) FILTER (WHERE l_linestatus = 'F') AS type_families, count(*) FILTER (WHERE l_linestatus = 'O') AS type_couples,
       0::BIGINT AS type_group_of_friends, 0::BIGINT AS type_solo_travellers, 0::BIGINT AS type_business_travellers,
       '{"en":' || count(*) FILTER (WHERE l_returnflag = 'A') || ',"pl":' || count(*) FILTER (WHERE l_returnflag = 'N') || '}' AS languages_json
FROM lineitem GROUP BY l_suppkey"""
    title = unescaped("regexp_extract(html, '(?s)<title[^>]*>(.*?)</title', 1)")
    sql["page_title_name"] = f"""
SELECT page_id, {stripped("CASE WHEN contains(t, ',') THEN split_part(t, ',', 1) ELSE split_part(t, '|', 1) END")} AS hotel_name
FROM (SELECT page_id, {title} AS t FROM pages)"""
    sql["section_fill_forward"] = """WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls)))::INTEGER AS place FROM s),
h AS (SELECT *, CASE WHEN regexp_matches(trim(line), '^([^.]+)[.]$') THEN regexp_extract(trim(line), '^([^.]+)[.]$', 1) END AS header FROM l),
f AS (SELECT *, last_value(header IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY place) AS section FROM h)
SELECT doc_id, place, section FROM f WHERE header IS NULL AND trim(line) <> ''"""
    return sql


def quoted_name(name: str) -> str:
    return f'"{name}"'
