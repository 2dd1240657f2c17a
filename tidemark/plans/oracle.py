"""DuckDB SQL for every registered query (the correctness oracle).

The SQL is written from the operator definitions, not from the Spark plans: it orders
visits with per-entity windows, finds successors through a dense rank of visit times,
censors with a running sum, and evaluates ranking metrics with ordinary window sums. The
tables region ... conversations are views registered by the checker.
"""

from __future__ import annotations

# Role views (same text as FIXTURES.md) and the shared pipeline steps.
BASE = """
WITH patients AS (
  SELECT c_custkey AS subject_id, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         CAST(18 + c_custkey % 70 AS INTEGER) AS anchor_age FROM customer),
admissions AS (
  SELECT o_orderkey AS hadm_id, o_custkey AS subject_id, o_orderdate AS admittime,
         o_orderdate + to_hours(CAST((o_orderkey * 7) % 480 + 1 AS INTEGER)) AS dischtime FROM orders),
diagnoses_icd AS (
  SELECT l_orderkey AS hadm_id, CAST(l_partkey AS VARCHAR) AS icd_code,
         CASE WHEN l_linestatus = 'F' THEN 9 ELSE 10 END AS icd_version FROM lineitem),
icd9_to_icd10 AS (SELECT CAST(p_partkey AS VARCHAR) AS icd9, CAST(p_partkey + p_size AS VARCHAR) AS icd10 FROM part),
icd10_to_ccsr AS (SELECT CAST(p_partkey AS VARCHAR) AS icd10, p_brand AS ccsr FROM part WHERE p_size <= 48),
d_icd AS (SELECT CAST(p_partkey AS VARCHAR) AS icd_code, p_name AS long_title FROM part WHERE p_size <= 45),
d_labitems AS (SELECT p_partkey AS itemid, p_type AS label FROM part),
labevents AS (
  SELECT l_orderkey AS hadm_id, l_partkey AS itemid, l_shipdate AS charttime,
         CASE l_returnflag WHEN 'R' THEN 'high' WHEN 'A' THEN 'abnormal' END AS flag FROM lineitem),
x9 AS (SELECT icd9, min(icd10) AS icd10 FROM icd9_to_icd10 WHERE icd9 IS NOT NULL GROUP BY icd9),
x10 AS (SELECT icd10, min(ccsr) AS ccsr FROM icd10_to_ccsr WHERE icd10 IS NOT NULL GROUP BY icd10),
coded AS (
  SELECT d.hadm_id, d.icd_code, d.icd_version,
         CASE WHEN d.icd_version IS NULL OR d.icd_version NOT IN (9, 10) THEN 'Invalid' ELSE x10.ccsr END AS ccsr_code
  FROM diagnoses_icd d
  LEFT JOIN x9 ON d.icd_version = 9 AND d.icd_code = x9.icd9
  LEFT JOIN x10 ON x10.icd10 = CASE WHEN d.icd_version = 9 THEN x9.icd10 WHEN d.icd_version = 10 THEN d.icd_code END),
mapped AS (SELECT c.*, t.long_title FROM coded c LEFT JOIN d_icd t ON c.icd_code = t.icd_code),
labs AS (
  SELECT l.hadm_id, l.itemid, l.charttime, l.flag, i.label,
         CAST(upper(coalesce(l.flag, '')) IN ('ABNORMAL', 'HIGH', 'LOW', 'CRITICAL') AS INTEGER) AS abnormal
  FROM labevents l JOIN d_labitems i ON l.itemid = i.itemid
  WHERE i.label IN ('PROMO', 'SMALL', 'LARGE')),
vflag AS (SELECT hadm_id, coalesce(max(CAST(ccsr_code = 'Brand#13' AS INTEGER)), 0) AS has_target
          FROM mapped GROUP BY hadm_id),
vdx AS (SELECT hadm_id, list_sort(list(long_title) FILTER (WHERE long_title IS NOT NULL)) AS diagnoses
        FROM mapped GROUP BY hadm_id HAVING count(long_title) > 0),
vlab AS (SELECT hadm_id, list_sort(list(DISTINCT label)) AS abnormal_labs
         FROM labs WHERE abnormal = 1 AND hadm_id IS NOT NULL GROUP BY hadm_id),
visits AS (
  SELECT a.hadm_id, a.subject_id, a.admittime,
         CAST(epoch_us(a.dischtime) - epoch_us(a.admittime) AS DOUBLE) / CAST(86400000000 AS DOUBLE) AS length_of_stay,
         coalesce(f.has_target, 0) AS has_target,
         coalesce(x.diagnoses, CAST([] AS VARCHAR[])) AS diagnoses,
         coalesce(l.abnormal_labs, CAST([] AS VARCHAR[])) AS abnormal_labs
  FROM admissions a LEFT JOIN vflag f USING (hadm_id) LEFT JOIN vdx x USING (hadm_id) LEFT JOIN vlab l USING (hadm_id)),
ordered AS (
  SELECT v.*,
         CAST(row_number() OVER (PARTITION BY subject_id ORDER BY admittime ASC NULLS LAST, hadm_id ASC NULLS LAST) - 1 AS INTEGER) AS visit_index,
         count(*) OVER (PARTITION BY subject_id) AS n_visits,
         min(admittime) OVER (PARTITION BY subject_id) AS first_time
  FROM visits v WHERE subject_id IS NOT NULL),
timed AS (
  SELECT subject_id, hadm_id, dense_rank() OVER (PARTITION BY subject_id ORDER BY admittime) AS dr
  FROM ordered WHERE admittime IS NOT NULL),
grp AS (SELECT subject_id, dr, min(hadm_id) AS first_hadm FROM timed GROUP BY subject_id, dr),
succ AS (
  SELECT t.hadm_id, g.first_hadm AS next_hadm_id, nv.has_target AS next_ckd
  FROM timed t JOIN grp g ON g.subject_id = t.subject_id AND g.dr = t.dr + 1
  JOIN visits nv ON nv.hadm_id = g.first_hadm),
demo AS (SELECT subject_id, arg_min(anchor_age, (anchor_age, gender)) AS age,
                arg_min(gender, (anchor_age, gender)) AS gender
         FROM patients WHERE subject_id IS NOT NULL GROUP BY subject_id),
cohort AS (
  SELECT o.subject_id, o.n_visits, d.age, d.gender FROM ordered o JOIN demo d USING (subject_id)
  WHERE o.visit_index = 0 AND o.n_visits >= 2 AND o.has_target = 0),
samp AS (
  SELECT o.*, s.next_hadm_id, CAST(s.next_ckd AS INTEGER) AS next_ckd, c.age, c.gender,
         coalesce(sum(s.next_ckd) OVER (PARTITION BY o.subject_id ORDER BY o.visit_index
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior_pos
  FROM ordered o JOIN succ s USING (hadm_id) JOIN cohort c USING (subject_id)),
kept AS (SELECT * FROM samp WHERE prior_pos = 0),
last_kept AS (SELECT subject_id, max(visit_index) AS last_index, count(*) AS k,
                     max(next_ckd) AS is_ckd, min(age) AS age, min(gender) AS gender
              FROM kept GROUP BY subject_id),
hist AS (SELECT o.*, l.k FROM ordered o JOIN last_kept l USING (subject_id) WHERE o.visit_index <= l.last_index),
items AS (
  SELECT DISTINCT subject_id, 'dx' AS kind, unnest(diagnoses) AS item FROM hist
  UNION ALL
  SELECT DISTINCT subject_id, 'lab' AS kind, unnest(abnormal_labs) AS item FROM hist),
items_d AS (SELECT DISTINCT subject_id, kind, item FROM items),
prow AS (
  SELECT l.subject_id AS patient_id, l.age, l.gender, CAST(l.is_ckd AS INTEGER) AS is_ckd,
         CAST(l.k * (l.k + 1) / 2 AS BIGINT) AS num_visits, l.k AS num_samples,
         CAST(l.last_index + 1 AS BIGINT) AS num_distinct_visits,
         coalesce((SELECT list_sort(list(item)) FROM items_d i WHERE i.subject_id = l.subject_id AND kind = 'dx'),
                  CAST([] AS VARCHAR[])) AS diagnoses,
         coalesce((SELECT list_sort(list(item)) FROM items_d i WHERE i.subject_id = l.subject_id AND kind = 'lab'),
                  CAST([] AS VARCHAR[])) AS abnormal_labs
  FROM last_kept l),
split AS (
  SELECT patient_id,
         CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'val' ELSE 'test' END AS split
  FROM (SELECT DISTINCT subject_id AS patient_id,
               ('0x' || substr(md5(concat('42:', CAST(subject_id AS VARCHAR))), 1, 8))::BIGINT % 100 AS b
        FROM kept)),
rows_split AS (SELECT p.*, s.split FROM prow p JOIN split s USING (patient_id)),
sentence AS (
  SELECT *, concat('The patient is a ', CAST(age AS VARCHAR), ' years old ',
                   CASE WHEN gender = 'M' THEN 'male' ELSE 'female' END,
                   '. Diagnoses include ', CASE WHEN len(diagnoses) = 0 THEN 'none' ELSE array_to_string(diagnoses, ', ') END,
                   '. Abnormal lab tests include ', CASE WHEN len(abnormal_labs) = 0 THEN 'none' ELSE array_to_string(abnormal_labs, ', ') END,
                   '.') AS formatted_history
  FROM rows_split),
cv_rows AS (SELECT *, is_ckd AS labels FROM sentence WHERE split IN ('train', 'val')),
cv_rank AS (
  SELECT patient_id, row_number() OVER (ORDER BY md5(concat('42:', CAST(patient_id AS VARCHAR))), patient_id) - 1 AS r,
         count(*) OVER () AS n FROM cv_rows),
folds AS (
  SELECT patient_id, CAST(CASE WHEN r < (n % 3) * (n // 3 + 1) THEN r // (n // 3 + 1)
                               ELSE (n % 3) + (r - (n % 3) * (n // 3 + 1)) // greatest(n // 3, 1) END AS INTEGER) AS fold
  FROM cv_rank),
docs AS (
  SELECT d.doc_id, l.quality AS label, CAST(d.n_chars AS DOUBLE) AS score,
         CASE WHEN CAST(d.n_chars AS DOUBLE) > 2000.0 THEN 1 ELSE 0 END AS prediction
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
doc_rank AS (
  SELECT doc_id, row_number() OVER (ORDER BY md5(concat('42:', CAST(doc_id AS VARCHAR))), doc_id) - 1 AS r,
         count(*) OVER () AS n FROM docs),
doc_folds AS (
  SELECT d.*, CAST(CASE WHEN r < (n % 3) * (n // 3 + 1) THEN r // (n // 3 + 1)
                        ELSE (n % 3) + (r - (n % 3) * (n // 3 + 1)) // greatest(n // 3, 1) END AS INTEGER) AS fold
  FROM docs d JOIN doc_rank USING (doc_id)),
"""


def _ranking(source: str, group: str) -> str:
    """CTEs st_*, cum_* and area_* for exact ROC/PR per ``group`` over ``source``
    (columns: group, score, label)."""
    return f"""
st AS (SELECT {group} AS grp, score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS p,
              sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS n
       FROM {source} WHERE score IS NOT NULL AND label IS NOT NULL GROUP BY {group}, score),
cum AS (SELECT grp, score, CAST(p AS DOUBLE) AS p, CAST(n AS DOUBLE) AS n,
               CAST(sum(p) OVER w AS DOUBLE) AS tp, CAST(sum(n) OVER w AS DOUBLE) AS fp,
               CAST(sum(p) OVER (PARTITION BY grp) AS DOUBLE) AS all_p,
               CAST(sum(n) OVER (PARTITION BY grp) AS DOUBLE) AS all_n
        FROM st WINDOW w AS (PARTITION BY grp ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
pts AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS prec,
               CASE WHEN (tp - p) + (fp - n) = 0 THEN 1.0 ELSE (tp - p) / ((tp - p) + (fp - n)) END AS prev_prec
        FROM cum),
area AS (SELECT grp, sum(n * (2 * tp - p) / 2.0) AS roc, sum(p * (prec + prev_prec) / 2.0) AS pr,
                sum(p) AS pos, sum(n) AS neg FROM pts GROUP BY grp),
rk AS (SELECT grp, CASE WHEN pos > 0 AND neg > 0 THEN roc / (pos * neg) END AS roc_auc,
              CASE WHEN pos > 0 THEN pr / pos END AS pr_auc,
              CAST(pos AS BIGINT) AS positives, CAST(neg AS BIGINT) AS negatives FROM area),
th AS (SELECT {group} AS grp,
              sum(CASE WHEN prediction = 1 AND label = 1 THEN 1 ELSE 0 END)::DOUBLE AS tp,
              sum(CASE WHEN prediction = 1 AND label <> 1 THEN 1 ELSE 0 END)::DOUBLE AS fp,
              sum(CASE WHEN prediction <> 1 AND label = 1 THEN 1 ELSE 0 END)::DOUBLE AS fn,
              sum(CASE WHEN prediction <> 1 AND label <> 1 THEN 1 ELSE 0 END)::DOUBLE AS tn
       FROM {source} GROUP BY {group}),
thm AS (SELECT grp, (tp + tn) / (tp + tn + fp + fn) AS accuracy,
               CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
               CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
               CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1 FROM th),
bundle AS (
  SELECT grp, 'accuracy' AS metric, accuracy AS value FROM thm UNION ALL
  SELECT grp, 'f1', f1 FROM thm UNION ALL
  SELECT grp, 'precision', precision FROM thm UNION ALL
  SELECT grp, 'recall', recall FROM thm UNION ALL
  SELECT grp, 'roc_auc', roc_auc FROM rk UNION ALL
  SELECT grp, 'pr_auc', pr_auc FROM rk)
"""


DOCS_ALL = _ranking("(SELECT 0 AS g, * FROM docs)", "g")
DOCS_BY_FOLD = _ranking("doc_folds", "fold")

CV_SUMMARY = DOCS_BY_FOLD + """,
summary AS (SELECT metric, avg(value) AS mean, stddev_pop(value) AS std FROM bundle GROUP BY metric),
best AS (SELECT arg_max(grp, (value, -grp)) AS fold, max(value) AS value FROM bundle
         WHERE metric = 'roc_auc' AND value > 0 HAVING count(*) > 0)
"""

Q: dict[str, str] = {
    "length_of_stay": """
SELECT hadm_id, subject_id, round(length_of_stay, 6) AS length_of_stay FROM visits""",
    "lab_abnormal_flag": """
SELECT hadm_id, itemid, flag,
       CAST(upper(coalesce(flag, '')) IN ('ABNORMAL', 'HIGH', 'LOW', 'CRITICAL') AS INTEGER) AS abnormal
FROM labevents""",
    "relevant_labs": "SELECT hadm_id, itemid, label, abnormal FROM labs",
    "lab_stats": "SELECT count(*) AS relevant_labs, CAST(sum(abnormal) AS BIGINT) AS abnormal_labs FROM labs",
    "crosswalk": "SELECT hadm_id, icd_code, icd_version, ccsr_code FROM coded",
    "dx_titles": """
SELECT d.hadm_id, d.icd_code, t.long_title FROM diagnoses_icd d LEFT JOIN d_icd t ON d.icd_code = t.icd_code""",
    "mapping_stats": """
SELECT count(*) AS total_codes, count(*) FILTER (WHERE ccsr_code IS DISTINCT FROM 'Invalid') AS valid_mappings,
       count(*) - count(*) FILTER (WHERE ccsr_code IS DISTINCT FROM 'Invalid') AS failed_mappings FROM mapped""",
    "mapping_stats_versions": """
SELECT count(*) AS total_codes,
       count(*) FILTER (WHERE v IN (9, 10)) AS valid_mappings, count(*) FILTER (WHERE v NOT IN (9, 10) OR v IS NULL) AS failed_mappings
FROM (SELECT l_partkey, CASE WHEN l_linenumber = 1 THEN 8 WHEN l_linenumber = 2 THEN NULL
                             WHEN l_linenumber % 2 = 0 THEN 9 ELSE 10 END AS v FROM lineitem) d
JOIN (SELECT p_partkey AS k FROM part UNION ALL SELECT p_partkey FROM part WHERE p_size <= 10) t ON t.k = d.l_partkey""",
    "dx_titles_versions": """
SELECT b AS by_version, hadm_id, icd_code, icd_version, long_title FROM (
  SELECT 0 AS b, d.*, t.long_title FROM vd d LEFT JOIN vt t ON t.icd_code = d.icd_code
  UNION ALL
  SELECT 1 AS b, d.*, t.long_title FROM vd d LEFT JOIN vt t ON t.icd_code = d.icd_code AND t.v = d.icd_version)""",
    "csv_titles": """
SELECT CAST(p_partkey AS VARCHAR) AS icd_code, 9 AS icd_version,
       concat(p_name, ' "', p_type, '",', chr(10), p_brand) AS long_title FROM part""",
    "csv_lab_events": """
SELECT l_orderkey AS hadm_id, l_partkey AS itemid, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS charttime,
       CASE WHEN l_linenumber % 3 = 0 THEN concat(l_returnflag, chr(10), '"', l_linestatus, '",', chr(10)) ELSE l_returnflag END AS flag
FROM lineitem""",
    "reduced_visit_lists": """
SELECT hadm_id, CAST(len(diagnoses) AS INTEGER) AS n_diagnoses, array_to_string(diagnoses, '|') AS diagnoses,
       array_to_string(abnormal_labs, '|') AS abnormal_labs FROM hist""",
    "visit_diagnoses": """
SELECT hadm_id, CAST(len(diagnoses) AS INTEGER) AS n_diagnoses, array_to_string(diagnoses, '|') AS diagnoses FROM vdx""",
    "visit_abnormal_labs": "SELECT hadm_id, array_to_string(abnormal_labs, '|') AS abnormal_labs FROM vlab",
    "visit_target_flag": "SELECT hadm_id, has_target FROM vflag",
    "visit_sequence": "SELECT subject_id, hadm_id, visit_index FROM ordered",
    "first_visit": """
SELECT subject_id, hadm_id AS first_hadm_id, has_target AS first_has_target FROM ordered WHERE visit_index = 0""",
    "days_since_first": """
SELECT subject_id, hadm_id, CAST((epoch_us(admittime) - epoch_us(first_time)) // 86400000000 AS INTEGER) AS days_since_first
FROM ordered""",
    "cohort": "SELECT subject_id, n_visits, age, gender FROM cohort",
    "cohort_attrition": """
SELECT count(*) AS all_patients, count(c.subject_id) AS valid_patients
FROM (SELECT DISTINCT subject_id FROM patients WHERE subject_id IS NOT NULL) p LEFT JOIN cohort c USING (subject_id)""",
    "next_visit": "SELECT hadm_id, next_hadm_id FROM succ",
    "next_label": """
SELECT o.subject_id, s.hadm_id, s.next_hadm_id, CAST(s.next_ckd AS INTEGER) AS next_ckd
FROM succ s JOIN ordered o USING (hadm_id)""",
    "censored_samples": "SELECT subject_id AS patient_id, hadm_id, next_ckd FROM kept",
    "next_event_samples": """
SELECT subject_id AS patient_id, hadm_id, visit_index, visit_index + 1 AS history_len, age, gender,
       next_hadm_id, next_ckd FROM kept""",
    "flatten_history": """
SELECT h.subject_id AS patient_id, s.visit_index AS sample_index, s.age, s.gender, s.next_ckd, h.hadm_id, h.visit_index,
       round(h.length_of_stay, 6) AS length_of_stay,
       CAST((epoch_us(h.admittime) - epoch_us(h.first_time)) // 86400000000 AS INTEGER) AS days_since_first,
       array_to_string(h.diagnoses, '|') AS diagnoses, array_to_string(h.abnormal_labs, '|') AS abnormal_labs
FROM kept s JOIN ordered h ON h.subject_id = s.subject_id AND h.visit_index <= s.visit_index""",
    "nested_samples": """
SELECT s.subject_id AS patient_id, s.visit_index, any_value(s.age) AS age, any_value(s.gender) AS gender,
       any_value(s.next_ckd) AS next_ckd, CAST(count(*) AS INTEGER) AS history_len,
       string_agg(CAST((epoch_us(h.admittime) - epoch_us(h.first_time)) // 86400000000 AS VARCHAR), '|' ORDER BY h.visit_index) AS days,
       string_agg(coalesce(array_to_string(h.diagnoses, '+'), ''), '|' ORDER BY h.visit_index) AS diagnoses,
       string_agg(coalesce(array_to_string(h.abnormal_labs, '+'), ''), '|' ORDER BY h.visit_index) AS abnormal_labs
FROM kept s JOIN ordered h ON h.subject_id = s.subject_id AND h.visit_index <= s.visit_index
GROUP BY s.subject_id, s.visit_index""",
    "job_patient_split": """
SELECT patient_id, is_ckd, CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'val' ELSE 'test' END AS split
FROM (SELECT patient_id, is_ckd,
             ('0x' || substr(md5(concat('7:', CAST(patient_id AS VARCHAR))), 1, 8))::BIGINT % 100 AS b FROM prow)""",
    "history_counts": """
SELECT subject_id AS patient_id, hadm_id, visit_index, round(length_of_stay, 6) AS length_of_stay,
       CAST((epoch_us(admittime) - epoch_us(first_time)) // 86400000000 AS INTEGER) AS days_since_first,
       CAST(k - visit_index AS BIGINT) AS copies FROM hist""",
    "patient_aggregate": """
SELECT patient_id, age, gender, is_ckd, num_visits, num_samples, num_distinct_visits,
       array_to_string(diagnoses, '|') AS diagnoses, array_to_string(abnormal_labs, '|') AS abnormal_labs FROM prow""",
    "patient_item_sets": """
SELECT patient_id, age, gender, is_ckd, num_visits, num_samples, num_distinct_visits,
       array_to_string(diagnoses, '|') AS diagnoses, array_to_string(abnormal_labs, '|') AS abnormal_labs FROM prow""",
    "split_item_coverage": """
SELECT split, is_ckd, kind, count(DISTINCT item) AS n
FROM (SELECT split, is_ckd, 'dx' AS kind, unnest(diagnoses) AS item FROM rows_split
      UNION ALL SELECT split, is_ckd, 'lab' AS kind, unnest(abnormal_labs) AS item FROM rows_split)
GROUP BY split, is_ckd, kind""",
    "patient_text": """
SELECT patient_id, array_to_string(diagnoses, ' ') AS diagnoses_str, array_to_string(abnormal_labs, ' ') AS abnormal_labs_str,
       concat('diagnoses:', array_to_string(diagnoses, ' '), ' , ', array_to_string(abnormal_labs, ' '),
              ' age:', CAST(age AS VARCHAR), ' , gender:', gender, ' , number of visits:', CAST(num_visits AS VARCHAR))
         AS patient_history FROM prow""",
    "clinical_sentence": "SELECT patient_id, formatted_history FROM sentence",
    "group_split": "SELECT patient_id, split FROM split",
    "group_split_exact": """
SELECT patient_id, CASE WHEN r < n - ceil(0.3::DOUBLE * n) THEN 'train'
                        WHEN r < n - ceil(0.5::DOUBLE * ceil(0.3::DOUBLE * n)) THEN 'val' ELSE 'test' END AS split
FROM (SELECT patient_id, row_number() OVER (ORDER BY md5(concat('42:', CAST(patient_id AS VARCHAR))), patient_id) - 1 AS r,
             count(*) OVER () AS n FROM (SELECT DISTINCT subject_id AS patient_id FROM kept))""",
    "split_stats": """
SELECT coalesce(split, 'total') AS split, count(*) AS samples, count(DISTINCT subject_id) AS patients,
       CAST(sum(next_ckd) AS BIGINT) AS positives, count(*) - CAST(sum(next_ckd) AS BIGINT) AS negatives
FROM kept k JOIN split s ON s.patient_id = k.subject_id GROUP BY ROLLUP (split)""",
    "class_distribution": "SELECT split, is_ckd, count(*) AS n FROM rows_split GROUP BY split, is_ckd",
    "aggregate_summary": """
SELECT split, count(*) AS total_patients, CAST(sum(is_ckd) AS BIGINT) AS ckd_positive,
       round(avg(num_visits), 6) AS avg_visits, count(*) - CAST(sum(is_ckd) AS BIGINT) AS ckd_negative,
       round(CAST(sum(is_ckd) AS DOUBLE) * 100.0::DOUBLE / CAST(count(*) AS DOUBLE), 1) AS pct_positive,
       round(CAST(count(*) - sum(is_ckd) AS DOUBLE) * 100.0::DOUBLE / CAST(count(*) AS DOUBLE), 1) AS pct_negative
FROM rows_split GROUP BY split""",
    "train_val_union": "SELECT patient_id, split, labels FROM cv_rows",
    "training_rows": """
SELECT patient_id, CASE WHEN split = 'test' THEN 'test' ELSE 'cv' END AS scope, formatted_history, is_ckd AS labels
FROM sentence""",
    "kfold": "SELECT patient_id, fold FROM folds",
    "kfold_sizes": """
SELECT fold, CAST(sum(count(*)) OVER () - count(*) AS BIGINT) AS n_train, count(*) AS n_val FROM folds GROUP BY fold""",
    "roc_auc": DOCS_ALL + "SELECT round(roc_auc, 6) AS roc_auc, positives, negatives FROM rk",
    "pr_auc": DOCS_ALL + "SELECT round(pr_auc, 6) AS pr_auc, positives, negatives FROM rk",
    "pr_curve": DOCS_ALL + """
SELECT round(score, 6) AS threshold, round(prec, 6) AS precision, round(tp / all_p, 6) AS recall,
       round(fp / all_n, 6) AS fpr, round(tp / all_p, 6) AS tpr FROM pts
UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE""",
    "argmax_prediction": "SELECT doc_id, prediction, score FROM docs",
    "classification_metrics": DOCS_ALL + """
SELECT round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1 FROM thm""",
    "metric_bundle": DOCS_ALL + "SELECT metric, round(value, 6) AS value FROM bundle",
    "fold_metrics": DOCS_BY_FOLD + "SELECT CAST(grp AS INTEGER) AS fold, metric, round(value, 6) AS value FROM bundle",
    "cv_summary": CV_SUMMARY + "SELECT metric, round(mean, 6) AS mean, round(std, 6) AS std FROM summary",
    "best_fold": CV_SUMMARY + "SELECT CAST(fold AS INTEGER) AS fold, round(value, 6) AS value FROM best",
    "metrics_report": CV_SUMMARY + """
SELECT 'avg_' || metric AS metric, concat('avg_' || metric, ': ', printf('%.4f', mean)) AS text FROM summary
UNION ALL SELECT 'std_' || metric, concat('std_' || metric, ': ', printf('%.4f', std)) FROM summary
UNION ALL SELECT 'best_roc_auc', concat('best_roc_auc: ', printf('%.4f', value)) FROM best""",
}

Q["encode_fixed_length"] = """
tr AS (SELECT patient_id, CASE WHEN split = 'test' THEN 'test' ELSE 'cv' END AS scope, is_ckd AS labels,
              list_filter(regexp_split_to_array(formatted_history, '\\s+'), lambda x: x <> '') AS toks FROM sentence),
vocab AS (SELECT tok, CAST(row_number() OVER (ORDER BY count(*) DESC, tok) + 1 AS INTEGER) AS id
          FROM (SELECT unnest(toks) AS tok FROM tr WHERE scope = 'cv') GROUP BY tok),
pieces AS (SELECT patient_id, unnest(toks) AS tok, unnest(range(0, len(toks))) AS pos FROM tr),
ided AS (SELECT p.patient_id, p.pos, coalesce(v.id, 1) AS id FROM pieces p LEFT JOIN vocab v ON v.tok = p.tok
         WHERE p.pos < 512),
per AS (SELECT patient_id, list(id ORDER BY pos) AS ids FROM ided GROUP BY patient_id)
SELECT t.patient_id, t.scope, t.labels,
       array_to_string(list_concat(coalesce(p.ids, CAST([] AS INTEGER[])),
                       list_transform(range(0, 512 - len(coalesce(p.ids, CAST([] AS INTEGER[])))), lambda x: 0)), ',') AS input_ids,
       CAST(len(coalesce(p.ids, CAST([] AS INTEGER[]))) AS INTEGER) AS n_tokens
FROM tr t LEFT JOIN per p USING (patient_id)"""

Q["encode_repeated_keys"] = Q["encode_fixed_length"].replace("512", "64").replace(
    "SELECT t.patient_id, t.scope, t.labels,", "SELECT t.patient_id AS row, CASE WHEN t.patient_id % 7 <> 0 THEN t.patient_id // 4 END AS patient_id, t.labels,"
).replace(""" AS input_ids,
       CAST(len(coalesce(p.ids, CAST([] AS INTEGER[]))) AS INTEGER) AS n_tokens""", " AS input_ids")

Q["dx_titles_versions"] = """
vd AS (SELECT l_orderkey AS hadm_id, CAST(l_partkey AS VARCHAR) AS icd_code,
              CASE WHEN l_linenumber = 1 THEN 8 WHEN l_linenumber = 2 THEN NULL
                   WHEN l_linenumber % 2 = 0 THEN 9 ELSE 10 END AS icd_version FROM lineitem),
vt AS (SELECT CAST(p_partkey AS VARCHAR) AS icd_code, 9 AS v, p_name AS long_title FROM part
       UNION ALL SELECT CAST(p_partkey AS VARCHAR), 10, concat(p_name, ' (10)') FROM part WHERE p_size <= 10)
""" + Q["dx_titles_versions"]

Q["fold_datasets"] = Q["encode_fixed_length"].replace("SELECT t.patient_id, t.scope, t.labels,", """,
enc AS (SELECT t.patient_id, t.scope, t.labels,""") + """)
SELECT r.run, CASE WHEN f.fold = r.run THEN 'val' ELSE 'train' END AS role, e.patient_id, e.labels, e.input_ids, e.n_tokens
FROM enc e JOIN folds f USING (patient_id), (SELECT CAST(unnest(range(0, 3)) AS INTEGER) AS run) r
WHERE e.scope = 'cv'"""

Q["class_weights"] = """
held AS (SELECT f.fold, c.labels AS label, count(*) AS held FROM cv_rows c JOIN folds f USING (patient_id)
         GROUP BY f.fold, c.labels),
tot AS (SELECT label, sum(held) AS n_all FROM held GROUP BY label),
tf AS (SELECT label, n_all, CAST(unnest(range(0, 3)) AS INTEGER) AS fold FROM tot),
per AS (SELECT g.fold, g.label, CAST(g.n_all - coalesce(h.held, 0) AS BIGINT) AS n_c
        FROM tf g LEFT JOIN held h ON h.fold = g.fold AND h.label = g.label)
SELECT fold, label, n_c, round(CAST(sum(n_c) OVER (PARTITION BY fold) AS DOUBLE) / CAST(count(*) OVER (PARTITION BY fold) * n_c AS DOUBLE), 6) AS weight
FROM per WHERE n_c > 0"""

# Event stream roles: user -> entity, event -> episode, purchase -> target.
EVENTS = """
WITH ev AS (SELECT user_id AS subject_id, event_id AS hadm_id, ts AS admittime,
                   CAST(event_type = 'purchase' AS INTEGER) AS has_target FROM events WHERE user_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY admittime ASC NULLS LAST, hadm_id ASC NULLS LAST) - 1 AS vi,
             count(*) OVER (PARTITION BY subject_id) AS nv FROM ev),
t AS (SELECT subject_id, hadm_id, dense_rank() OVER (PARTITION BY subject_id ORDER BY admittime) AS dr
      FROM o WHERE admittime IS NOT NULL),
g AS (SELECT subject_id, dr, min(hadm_id) AS first_hadm FROM t GROUP BY subject_id, dr),
s AS (SELECT t.hadm_id, g.first_hadm AS next_hadm_id, nv.has_target AS next_ckd
      FROM t JOIN g ON g.subject_id = t.subject_id AND g.dr = t.dr + 1 JOIN ev nv ON nv.hadm_id = g.first_hadm),
c AS (SELECT subject_id FROM o WHERE vi = 0 AND nv >= 2 AND has_target = 0),
sm AS (SELECT o.*, s.next_hadm_id, s.next_ckd,
              coalesce(sum(s.next_ckd) OVER (PARTITION BY o.subject_id ORDER BY o.vi
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior_pos
       FROM o JOIN s USING (hadm_id) JOIN c USING (subject_id))
SELECT subject_id AS user_id, hadm_id AS event_id, CAST(vi + 1 AS INTEGER) AS history_len,
       next_hadm_id AS next_event_id, CAST(next_ckd AS INTEGER) AS next_ckd FROM sm WHERE prior_pos = 0"""


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, body in Q.items():
        text = body.strip()
        if text.upper().startswith("SELECT"):
            # the shared CTE list ends with a comma; close it with a no-op CTE
            out[name] = BASE + "_end AS (SELECT 1)\n" + text
        else:
            out[name] = BASE + text
    out["event_samples"] = EVENTS.strip()
    return out
