"""Cohort tables, matched groups and the training table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import subject_key
from ..operators import cohort as op
from ..operators import matching, selection, training
from ..session import cut, table
from . import sql

N, AGE, COLUMNS = 10, 1, ("etudegp", "profq2")
CONFLICTS = [("success", "manifest"), ("manifest", "success"), ("used", "success")]


def _recoded(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "covariates").withColumn("ident_projet", subject_key(F.col("ident_projet"))).where("ident_projet IS NOT NULL")
    return op.recode(raw).distinct()


def _cohort(spark, d):
    return cut(matching.with_risk_time(_recoded(spark, d).where("birth_date IS NOT NULL")))


def covariate_recode(spark, d):
    return _recoded(spark, d)


def wave_dates(spark, d):
    return op.wave_summary(op.wave_dates(_recoded(spark, d)))


def entry_quartiles(spark, d):
    return op.entry_quartiles(_recoded(spark, d))


def answer_shares(spark, d):
    return op.answer_shares(_recoded(spark, d), ["rempli_seulq11", "rempli_seulq12"])


def _base(spark, d):
    return _recoded(spark, d).select("id")


def _wide(spark, d):
    keyed = lambda t: table(spark, d, t).select(subject_key(F.col("e3n_id_hand")).alias("id"), "q", *(["used"] if t == "manifest" else []))
    manifest = keyed("manifest")
    return op.availability(_base(spark, d), {"manifest": manifest, "success": keyed("combined_success_ids"), "used": manifest.where("used")})


def availability_wide(spark, d):
    return _wide(spark, d)


def availability_patterns(spark, d):
    """Patterns of the manifest's waves, as text and bits, and the subjects that have each."""
    text = op.pattern("manifest")
    return _wide(spark, d).groupBy(text.alias("pattern")).agg(F.count("*").alias("n_subjects")).withColumn("bits", op.mask(F.col("pattern")))


def flag_conflicts(spark, d):
    return op.flag_conflicts(_wide(spark, d), CONFLICTS)


def status_code(spark, d):
    runs = table(spark, d, "manifest").withColumn("id", subject_key(F.col("e3n_id_hand")))
    return op.status(_base(spark, d), runs.where("q IS NOT NULL"))


def scalar_lookup(spark, d):
    facts = table(spark, d, "training").withColumn("id", subject_key(F.substring_index("unique_id", "_", 1)))
    columns = ["q_5_num_x", "q_5_num_text", "q_5_num_digit"]
    return op.first_values(_base(spark, d), op.drop_empty(facts, columns).where("id IS NOT NULL"), columns, "row_id")


def _matched(spark, d, mode):
    return matching.match(_cohort(spark, d), N, mode, AGE, COLUMNS)


def case_control_exact(spark, d):
    return _matched(spark, d, "exact")


def case_control_at_least(spark, d):
    return _matched(spark, d, "at_least")


def case_control_fallback(spark, d):
    return _matched(spark, d, "exact_w_fallback")


def match_failed(spark, d):
    return matching.failed(_cohort(spark, d), _matched(spark, d, "exact"))


def match_summary(spark, d):
    return matching.summary(_matched(spark, d, "exact_w_fallback"), N)


def match_group_sizes(spark, d):
    return matching.group_sizes(_matched(spark, d, "exact_w_fallback"))


def exclude_assisted(spark, d):
    return matching.exclude_assisted(_recoded(spark, d)).select("id", "is_case")


def training_table(spark, d):
    """The training table of the fallback match: patterns from the manifest, runs as grid files, a large warning as flag."""
    wide = _wide(spark, d)
    manifest = table(spark, d, "manifest").where("warning_censoring = 'large' AND warning_ordering = 'Second stage'").select(subject_key(F.col("e3n_id_hand")).alias("id")).distinct()
    patterns = wide.select("id", op.pattern("manifest").alias("rempli_pattern"), op.pattern("success").alias("grid_pattern"))
    subjects = _recoded(spark, d).select("id", "exit_date", *(f"dateq{q}" for q in range(1, 14))).join(patterns, "id").join(manifest.withColumn("flagged", F.lit(1)), "id", "left").fillna({"flagged": 0})
    rows = training.training_table(cut(_matched(spark, d, "exact_w_fallback")), cut(subjects))
    return rows.select("unique_id", "split", "case_control", "last_q", "rempli_pattern", "case_pattern", "grid_pattern", "case_grid_pattern", "at_least_warning", *(F.round(f"case_dt_dateq{q}", 6).alias(f"case_dt_dateq{q}") for q in range(1, 14)))


def assign_sized_splits(spark, d):
    return training.assign_sized(_base(spark, d), "id", 20, 5, 5)


def single_split(spark, d):
    return training.single_split(_recoded(spark, d).where("lateralite <> 9"), "id")


def tertile_balanced_split(spark, d):
    """Left-handed subjects and twice as many others, by thirds of the number of waves with a grid file (a successful run)."""
    files = sum((F.col(f"q{q}_success") for q in range(1, 14)), F.lit(0))
    rows = _recoded(spark, d).where("lateralite IN (1, 2)").join(_wide(spark, d).select("id", files.alias("files")), "id")
    return training.balanced_by_tertile(rows.select("id", (F.col("lateralite") == 2).cast("int").alias("label"), "files"), "id", "label", "files", 2)


def select_waves(spark, d):
    """Waves to show of each training row, in each mode."""
    rows = table(spark, d, "training")
    p, last = F.col("grid_pattern"), F.col("last_avail_q")
    modes = {"all": {}, "upto_last_avail": {}, "before_last_avail": {"inclusive": False}, "after_last_avail": {}, "from_last_avail": {"inclusive": False}, "last_available": {}, "custom": {"custom": [7, 2, 7, 0, 99]}}
    name = {"before_last_avail": "upto_last_avail", "from_last_avail": "after_last_avail"}
    return rows.select("row_id", *(F.concat_ws(",", selection.select_waves(p, last, name.get(m, m), **k)).alias(m) for m, k in modes.items()))


def _training(spark, d):
    rows = table(spark, d, "training").where("unique_id IS NOT NULL").dropDuplicates(["unique_id"]).select("unique_id")
    full = table(spark, d, "training").groupBy("unique_id").agg(F.max("case_control").alias("case_control"), F.min("grid_pattern").alias("grid_pattern"), F.min("split").alias("split"))
    both = rows.join(full, "unique_id")
    return both.select("unique_id", subject_key(selection.subject_of(F.col("unique_id"))).alias("subject"), subject_key(selection.group_of(F.col("unique_id"))).alias("grp"), "case_control", "grid_pattern", "split")


def group_selection(spark, d):
    rows = _training(spark, d).groupBy("grp", "subject").agg(F.max("case_control").alias("case_control"))
    return selection.select_group(rows, "grp", "subject", "case_control").select("grp", "subject", "position")


def group_grid(spark, d):
    rows = _training(spark, d).where("grp IS NOT NULL").groupBy("grp", "subject").agg(F.min("grid_pattern").alias("grid_pattern"))
    return selection.group_grid(rows, "grp", "subject", "grid_pattern")


def subject_search(spark, d):
    return selection.search(_training(spark, d), ["train"], True, "12").select("unique_id")


def group_split(spark, d):
    """Splits by matched group, then one per subject."""
    rows = table(spark, d, "training").select("row_id", subject_key(F.substring_index("unique_id", "_", 1)).alias("subject"), subject_key(selection.group_of(F.col("unique_id"))).cast("long").alias("grp"), "case_control")
    with_split = rows.join(training.assign_groups(rows, "grp"), "grp", "left")
    return training.one_split_per_subject(with_split, "subject", "case_control", "grp").select("row_id", "split")


_DATES = ", ".join(f"{sql.day(f'dateq{q}')} AS dateq{q}" for q in range(1, 14))
_RECODED = f"""SELECT DISTINCT {sql.subject('ident_projet')} AS id, diag_park_final1_quest AS is_case, CASE WHEN profq2 IS NULL THEN 9 WHEN profq2 LIKE 'ENE%' THEN 1 ELSE 0 END AS profq2,
  {', '.join(f'coalesce({c}, 9) AS {c}' for c in ('lateralite', 'etudegp', 'rempli_seulq11', 'rempli_seulq12'))},
  CASE WHEN birth_month BETWEEN 1 AND 12 THEN make_date(birth_year, birth_month, 1) END AS birth_date, {sql.day('date_suivi_diag1_quest')} AS exit_date, {_DATES}
  FROM covariates WHERE {sql.subject('ident_projet')} IS NOT NULL AND NOT coalesce(aexclure = 1, false)"""
_WITH_AGE = f"SELECT *, datediff('day', birth_date, dateq1) / 365.25 AS age_at_entry, round_even(datediff('day', birth_date, dateq1) / 365.25, 0)::INT AS age_at_entry_int FROM ({_RECODED})"
_LONG = f"SELECT id, unnest(range(1, 14))::INT AS q, unnest([{', '.join(f'dateq{q}' for q in range(1, 14))}]) AS filled_on FROM ({_RECODED})"
_KEYED = {
    "manifest": f"SELECT {sql.subject('e3n_id_hand')} AS id, q FROM manifest",
    "success": f"SELECT {sql.subject('e3n_id_hand')} AS id, q FROM combined_success_ids",
    "used": f"SELECT {sql.subject('e3n_id_hand')} AS id, q FROM manifest WHERE used",
}
_FLAGS = ", ".join(f"max((f = '{f}' AND q = {q})::INT) AS q{q}_{f}" for q in range(1, 14) for f in _KEYED)
_NAMES = [f"q{q}_{f}" for q in range(1, 14) for f in _KEYED]
_WIDE = f"""SELECT b.id, {', '.join(f'coalesce({n}, 0) AS {n}' for n in _NAMES)} FROM (SELECT DISTINCT id FROM ({_RECODED})) b
  LEFT JOIN (SELECT id, {_FLAGS} FROM ({' UNION ALL '.join(f"SELECT id, q, '{f}' AS f FROM ({s})" for f, s in _KEYED.items())}) WHERE q IS NOT NULL GROUP BY id) w ON w.id = b.id"""


def _pattern(fact: str) -> str:
    return " || ".join(f"q{q}_{fact}" for q in range(1, 14))


_COHORT = f"""SELECT *, datediff('day', dateq1, exit_date) / 365.25 AS t, round_even(datediff('day', (SELECT min(birth_date) FROM ({_RECODED})), birth_date) / 365.25, 0)::INT AS age,
  ({' + '.join(f'(dateq{q} IS NOT NULL)::BIGINT * {1 << (q - 1)}' for q in range(1, 14))}) AS a,
  coalesce({', '.join(f'CASE WHEN dateq{q} >= exit_date THEN {q} END' for q in range(1, 14))}, 13) AS cut FROM ({_RECODED}) WHERE birth_date IS NOT NULL"""
_COHORT = f"SELECT *, coalesce({', '.join(f'CASE WHEN {q} < cut AND dateq{q} IS NOT NULL THEN {q} END' for q in range(13, 0, -1))}, 0) AS last_q FROM ({_COHORT})"


def _match(mode: str) -> str:
    fits = "exact" if mode == "exact" else "enough"
    tier = "CASE WHEN exact THEN 0 ELSE 1 END" if mode == "exact_w_fallback" else "0"
    left = {"exact": "n_exact", "at_least": "n_at_least"}.get(mode, f"CASE WHEN n_exact >= {N} THEN n_exact WHEN n_exact IS NOT NULL THEN least({N}, n_at_least) END")
    return f"""
WITH c AS MATERIALIZED ({_COHORT}),
cases AS (SELECT id AS case_id, last_q, row_number() OVER (ORDER BY id) AS match_group, t, age, a, etudegp, profq2 FROM c WHERE is_case = 1 AND last_q > 0),
pairs AS (SELECT k.case_id, o.id AS control_id, (k.a & ((1 << k.last_q) - 1)) = (o.a & ((1 << k.last_q) - 1)) AS exact, (o.a & k.a & ((1 << k.last_q) - 1)) = (k.a & ((1 << k.last_q) - 1)) AS enough
  FROM cases k JOIN c o ON o.etudegp = k.etudegp AND o.profq2 = k.profq2 AND abs(o.age - k.age) <= {AGE} AND o.t >= k.t AND o.id <> k.case_id),
n AS (SELECT case_id, count(*) AS n_candidates, count(*) FILTER (WHERE exact) AS n_exact, count(*) FILTER (WHERE enough) AS n_at_least FROM pairs GROUP BY 1),
drawn AS (SELECT case_id, control_id AS member_id, 0 AS case_control, {tier} AS tier FROM pairs WHERE {fits}
  QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY {tier}, md5(concat_ws('|', 42, case_id, control_id)), control_id) <= {N}),
members AS (SELECT * FROM drawn UNION ALL SELECT case_id, case_id, 1, 0 FROM cases)
SELECT match_group, case_id, member_id, case_control, last_q, tier, coalesce(n_candidates, 0) AS n_candidates, coalesce(n_exact, 0) AS n_exact, coalesce(n_at_least, 0) AS n_at_least,
  coalesce({left}, 0) AS n_left FROM members JOIN cases USING (case_id) LEFT JOIN n USING (case_id)"""


def _ranked(key: str, source: str, seed: int = 42) -> str:
    return f"SELECT {key}, row_number() OVER (ORDER BY md5('{seed}|' || {key}::VARCHAR), {key}) - 1 AS r, count(*) OVER () AS n FROM (SELECT DISTINCT {key} FROM {source} WHERE {key} IS NOT NULL)"


_GROUPED = "SELECT {key}, CASE WHEN r < n - t - v THEN 'train' WHEN r < n - t THEN 'val' ELSE 'test' END AS split FROM (SELECT *, floor((n - t) * 0.1)::BIGINT AS v FROM (SELECT *, floor(n * 0.1)::BIGINT AS t FROM ({ranked})))"
_SINGLE = "CASE WHEN r < v THEN 'val' WHEN r <= v + t THEN 'test' ELSE 'train' END AS split FROM (SELECT *, floor((n - t) * 0.1)::BIGINT AS v FROM (SELECT *, floor(n * {share})::BIGINT AS t FROM ({ranked})))"
_TRAINING = f"""SELECT unique_id, {sql.subject("split_part(unique_id, '_', 1)")} AS subject, {sql.subject("regexp_extract(unique_id, '^[^_]*_?(.*)$', 1)")} AS grp,
  max(case_control) AS case_control, min(grid_pattern) AS grid_pattern, min(split) AS split FROM training WHERE unique_id IS NOT NULL GROUP BY unique_id"""
_WAVES = "list_filter(range(1, 14), lambda q: grid_pattern IS NULL OR substr(grid_pattern, q::INT, 1) = '1')"
_ROWS = f"SELECT row_id, {sql.subject("split_part(unique_id, '_', 1)")} AS subject, {sql.subject("regexp_extract(unique_id, '^[^_]*_?(.*)$', 1)")}::BIGINT AS grp, case_control FROM training"

QUERIES = {
    f.__name__: f
    for f in (
        covariate_recode, wave_dates, entry_quartiles, answer_shares, availability_wide, availability_patterns, flag_conflicts, status_code, scalar_lookup,
        case_control_exact, case_control_at_least, case_control_fallback, match_failed, match_summary, match_group_sizes, exclude_assisted, training_table,
        assign_sized_splits, single_split, tertile_balanced_split, select_waves, group_selection, group_grid, subject_search, group_split,
    )
}
SQL = {
    "covariate_recode": _WITH_AGE,
    "wave_dates": f"SELECT q, count(*) AS n, min(filled_on) AS first_on, max(filled_on) AS last_on FROM ({_LONG}) WHERE filled_on IS NOT NULL GROUP BY q",
    "entry_quartiles": f"""
WITH c AS (SELECT *, datediff('day', DATE '1970-01-01', dateq1) AS d FROM ({_RECODED}) WHERE dateq1 IS NOT NULL), k AS (SELECT quantile_cont(d, 0.25) AS lo, quantile_cont(d, 0.75) AS hi FROM c)
SELECT CASE WHEN d <= lo THEN 'first' ELSE 'last' END AS quartile, count(*) AS n_subjects, min(dateq1) AS first_on, max(dateq1) AS last_on, round(avg(datediff('day', dateq1, exit_date) / 365.25), 6) AS mean_years
FROM c, k WHERE d <= lo OR d >= hi GROUP BY 1""",
    "answer_shares": f"""
WITH l AS (SELECT question, members, answer FROM (SELECT 'rempli_seulq11' AS question, rempli_seulq11 AS answer, is_case FROM ({_RECODED}) UNION ALL SELECT 'rempli_seulq12', rempli_seulq12, is_case FROM ({_RECODED})) r, (VALUES ('all'), ('cases')) m(members) WHERE members = 'all' OR is_case = 1),
n AS (SELECT question, members, answer, count(*) AS n FROM l GROUP BY ALL)
SELECT *, CASE WHEN answer <> 9 THEN n / sum(n) FILTER (WHERE answer <> 9) OVER (PARTITION BY question, members) END AS share FROM n""",
    "availability_wide": _WIDE,
    "availability_patterns": f"SELECT {_pattern('manifest')} AS pattern, count(*) AS n_subjects, ({' + '.join(f'q{q}_manifest::BIGINT * {1 << (q - 1)}' for q in range(1, 14))}) AS bits FROM ({_WIDE}) GROUP BY 1, 3",
    "flag_conflicts": " UNION ALL ".join(f"SELECT {q} AS q, '{a} without {b}' AS conflict, count(*) FILTER (WHERE q{q}_{a} = 1 AND q{q}_{b} = 0) AS n_ids, min(id) FILTER (WHERE q{q}_{a} = 1 AND q{q}_{b} = 0) AS example FROM w" for q in range(1, 14) for a, b in CONFLICTS),
    "status_code": f"""
WITH m AS (SELECT {sql.subject('e3n_id_hand')} AS id, q, max(CASE WHEN warning_ordering LIKE '%OCR%' THEN 3 WHEN warning_ordering = 'First stage' THEN 0 WHEN warning_ordering = 'Second stage' THEN 1 ELSE 2 END) AS c, max(CASE WHEN warning_censoring LIKE '%large%' THEN 1 ELSE 0 END) AS l
  FROM manifest WHERE q IS NOT NULL GROUP BY 1, 2)
SELECT b.id, m.q, coalesce(c, -1) AS ordering_code, coalesce(l, -1) AS large_warning FROM (SELECT DISTINCT id FROM ({_RECODED})) b LEFT JOIN m ON m.id = b.id""",
    "scalar_lookup": f"""
WITH f AS (SELECT {sql.subject("split_part(unique_id, '_', 1)")} AS id, * EXCLUDE (subject_id) FROM training WHERE coalesce(q_5_num_x, q_5_num_text, q_5_num_digit) IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_id) = 1)
SELECT b.id, coalesce(q_5_num_x, -1)::DOUBLE AS q_5_num_x, coalesce(q_5_num_text, -1)::DOUBLE AS q_5_num_text, coalesce(q_5_num_digit, -1)::DOUBLE AS q_5_num_digit FROM (SELECT DISTINCT id FROM ({_RECODED})) b LEFT JOIN f ON f.id = b.id""",
    "case_control_exact": _match("exact"),
    "case_control_at_least": _match("at_least"),
    "case_control_fallback": _match("exact_w_fallback"),
    "match_failed": f"SELECT id AS case_id, 'no_questionnaires' AS reason FROM ({_COHORT}) WHERE is_case = 1 AND last_q = 0 UNION ALL SELECT case_id, 'no_matches' FROM ({_match('exact')}) WHERE case_control = 1 AND n_left = 0",
    "match_summary": f"""
WITH m AS MATERIALIZED ({_match('exact_w_fallback')}), g AS (SELECT match_group, count(*) AS size, max(tier) AS tier FROM m GROUP BY 1), u AS (SELECT member_id, count(*) AS uses FROM m WHERE case_control = 0 GROUP BY 1)
SELECT * FROM (SELECT count(*) AS n_groups, count(*) FILTER (WHERE size <= {N}) AS n_short, count(*) FILTER (WHERE tier > 0) AS n_fallback, min(size) AS least_size, max(size) AS most_size FROM g),
  (SELECT count(*) AS n_unique_controls, coalesce(sum(uses), 0)::BIGINT AS n_controls, count(*) FILTER (WHERE uses > 3) AS n_used_over_3, count(*) FILTER (WHERE uses > 5) AS n_used_over_5, coalesce(max(uses), 0) AS most_uses FROM u)""",
    "match_group_sizes": f"SELECT size, count(*) AS n_groups FROM (SELECT match_group, count(*) AS size FROM ({_match('exact_w_fallback')}) GROUP BY 1) GROUP BY size",
    "exclude_assisted": f"SELECT id, is_case FROM ({_RECODED}) WHERE coalesce(is_case = 1, false) OR NOT coalesce(rempli_seulq11 = 0 OR (rempli_seulq11 = 9 AND rempli_seulq12 = 0), false)",
    "training_table": f"""
WITH m AS MATERIALIZED ({_match('exact_w_fallback')}), w AS MATERIALIZED ({_WIDE}), r AS MATERIALIZED ({_RECODED}),
bad AS (SELECT DISTINCT {sql.subject('e3n_id_hand')} AS id FROM manifest WHERE warning_censoring = 'large' AND warning_ordering = 'Second stage'),
rows_ AS (SELECT m.match_group, member_id, case_control, m.last_q, {_pattern('manifest')} AS rempli_pattern, {_pattern('success')} AS grid_pattern, r.* FROM m JOIN r ON r.id = member_id JOIN w ON w.id = member_id
  WHERE member_id NOT IN (SELECT id FROM bad WHERE id IS NOT NULL) AND match_group NOT IN (SELECT match_group FROM m WHERE case_control = 1 AND member_id IN (SELECT id FROM bad))),
s AS ({_GROUPED.format(key='match_group', ranked=_ranked('match_group', 'rows_'))}),
o AS (SELECT member_id, s.split FROM rows_ JOIN s USING (match_group) QUALIFY row_number() OVER (PARTITION BY member_id ORDER BY case_control DESC, match_group) = 1),
u AS (SELECT rows_.*, o.split, member_id || '_' || lpad(match_group::VARCHAR, greatest(length(match_group::VARCHAR), (SELECT length(max(match_group)::VARCHAR) FROM rows_))::INT, '0') AS unique_id FROM rows_ JOIN o USING (member_id))
SELECT a.unique_id, a.split, a.case_control, a.last_q, a.rempli_pattern, c.rempli_pattern AS case_pattern, a.grid_pattern, c.grid_pattern AS case_grid_pattern,
  (left(a.rempli_pattern, a.last_q) IS DISTINCT FROM left(c.rempli_pattern, a.last_q))::INT AS at_least_warning,
  {', '.join(f"round(datediff('day', c.exit_date, c.dateq{q}) / 365.25, 6) AS case_dt_dateq{q}" for q in range(1, 14))}
FROM u a LEFT JOIN u c ON c.match_group = a.match_group AND c.case_control = 1""",
    "assign_sized_splits": f"SELECT id, CASE WHEN r < 20 THEN 'train' WHEN r < 25 THEN 'val' WHEN r < 30 THEN 'test' END AS split FROM ({_ranked('id', f'({_RECODED})')})",
    "single_split": "SELECT id, " + _SINGLE.format(share=0.2, ranked=_ranked("id", f"(SELECT * FROM ({_RECODED}) WHERE lateralite <> 9)")),
    "tertile_balanced_split": f"""
WITH w AS MATERIALIZED ({_WIDE}), x AS (SELECT r.id AS key, (lateralite = 2)::INT AS label, {' + '.join(f'q{q}_success' for q in range(1, 14))} AS size FROM ({_RECODED}) r JOIN w ON w.id = r.id WHERE lateralite IN (1, 2)),
k AS (SELECT quantile_cont(size, 1.0 / 3) AS a, quantile_cont(size, 2.0 / 3) AS b FROM x), y AS (SELECT x.*, CASE WHEN size <= a THEN 1 WHEN size <= b THEN 2 ELSE 3 END AS bin FROM x, k),
z AS (SELECT *, count(*) FILTER (WHERE label = 1) OVER (PARTITION BY bin) AS pos, row_number() OVER (PARTITION BY bin, label ORDER BY md5('42|' || key), key) AS i FROM y)
SELECT key, label, bin, {_SINGLE.format(share=0.1, ranked="SELECT *, row_number() OVER (PARTITION BY bin ORDER BY md5('43|' || key), key) - 1 AS r, count(*) OVER (PARTITION BY bin) AS n FROM z WHERE label = 1 OR i <= 2 * pos")}""",
    "select_waves": f"""SELECT row_id, array_to_string(w, ',') AS "all", {', '.join(f"array_to_string(list_filter(w, lambda q: last_avail_q IS NULL OR q {o} last_avail_q), ',') AS {n}" for n, o in (('upto_last_avail', '<='), ('before_last_avail', '<'), ('after_last_avail', '>'), ('from_last_avail', '>=')))},
  coalesce(list_max(w)::VARCHAR, '') AS last_available, '2,7' AS custom
FROM (SELECT *, {_WAVES} AS w FROM training)""",
    "group_selection": f"""
WITH t AS (SELECT grp, subject, max(case_control) AS cc FROM ({_TRAINING}) GROUP BY 1, 2), n AS (SELECT *, coalesce(cc, 0) = 1 AS c, row_number() OVER (PARTITION BY grp, coalesce(cc, 0) = 1 ORDER BY subject NULLS LAST) AS i FROM t)
SELECT grp, subject, row_number() OVER (PARTITION BY grp ORDER BY c DESC, subject NULLS LAST)::INT AS position FROM n WHERE c OR i <= 2""",
    "group_grid": f"""
WITH t AS (SELECT grp, subject, min(grid_pattern) AS grid_pattern FROM ({_TRAINING}) WHERE grp IS NOT NULL GROUP BY 1, 2), h AS (SELECT grp, subject, unnest({_WAVES})::INT AS q FROM t)
SELECT t.grp, t.subject, e.q, h.q IS NOT NULL AS present FROM t JOIN (SELECT DISTINCT grp, q FROM h) e ON e.grp = t.grp LEFT JOIN h ON h.grp = t.grp AND h.subject = t.subject AND h.q = e.q""",
    "subject_search": f"SELECT unique_id FROM ({_TRAINING}) WHERE split = 'train' AND case_control = 1 AND unique_id LIKE '%12%'",
    "group_split": f"""
WITH x AS ({_ROWS}), s AS ({_GROUPED.format(key='grp', ranked=_ranked('grp', 'x'))}),
o AS (SELECT subject, split FROM x JOIN s USING (grp) QUALIFY row_number() OVER (PARTITION BY subject ORDER BY coalesce(case_control, 0) DESC, grp) = 1)
SELECT x.row_id, o.split FROM x LEFT JOIN o USING (subject)""",
}
SQL["flag_conflicts"] = f"WITH w AS MATERIALIZED ({_WIDE}) {SQL['flag_conflicts']}"
