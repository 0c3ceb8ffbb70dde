"""The same results in DuckDB SQL, for the queries that SQL can express.

RE2 has neither look-around nor back-references, so those patterns are written out differently here.
"""

from __future__ import annotations

import json

from textlab.catalog import views as V
from textlab.catalog.queries import SAMPLE_FRACTION, SERVED
from textlab.functions import signals as G
from textlab.functions.words import NEGATORS, STOP_WORDS
from textlab.operators import runlog as R, scoring
from textlab.plans import configurations as C

WORD = r"[\p{L}\p{N}_]"
OTHER = r"[^\p{L}\p{N}_]"
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
NOT_SPACE = r"[^\t-\r\x1c-\x20\x85\p{Z}]"
H = V.duckdb_hash


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(words) -> str:
    return "(" + ", ".join(quoted(w) for w in words) + ")"


def with_(parts: list[str], body: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + body


def over(view: str, body: str, *more: str) -> str:
    return with_([*V.duckdb_views(*view.split()), *more], body)


# --- text -------------------------------------------------------------------------------------------


def urls(text: str, to: str = "url") -> str:
    return f"regexp_replace({text}, 'https?://{NOT_SPACE}+|www\\.{NOT_SPACE}+', '{to}', 'g')"


def mentions(text: str, to: str = "user") -> str:
    return f"regexp_replace({text}, '@{WORD}+', '{to}', 'g')"


def spaces(text: str) -> str:
    return f"trim(regexp_replace({text}, '{SPACE}+', ' ', 'g'))"


def clean_b0(text: str) -> str:
    return spaces(mentions(urls(f"lower({text})")))


def squeezed(source: str, text: str, keep: str) -> str:
    """Keep a character unless it is the third or later of a run; line breaks stay."""
    return (
        f"SELECT {keep}, coalesce(array_to_string(list_filter(ch, lambda x, i: NOT (i > 2 AND x <> chr(10) "
        f"AND x = ch[i - 1] AND x = ch[i - 2])), ''), '') AS squeezed "
        f"FROM (SELECT {keep}, string_split({text}, '') AS ch FROM {source})"
    )


# The emoji of the `tweets` view and their names.
EMOJI_NAMES = {
    "❤️": "heavy_black_heart", "😀": "grinning_face", "👍🏽": "thumbs_up_sign_emoji_modifier_fitzpatrick_type-4", "🇫🇷": "flag_fr",
    "⭐": "white_medium_star", "⌚": "watch", "👩‍💻": "woman_personal_computer",
}


def emoji(text: str) -> str:
    for key, name in EMOJI_NAMES.items():
        text = f"replace({text}, '{key}', ' :{name}: ')"
    return text


def words(text: str) -> str:
    clitic = "''(?:s|m|re|ve|ll|d)"
    apart = f"regexp_replace(regexp_replace({text}, '(?i)(n''t)', ' \\1', 'g'), '(?i)({clitic})', ' \\1', 'g')"
    return f"regexp_extract_all({apart}, '(?i)n''t|{clitic}|{WORD}+|{NOT_SPACE}')"


def without_stopwords(tokens: str, kept=()) -> str:
    dropped = sorted({w.lower() for w in STOP_WORDS} - set(kept))
    return f"list_filter({tokens}, lambda x: lower(x) NOT IN {in_list(dropped)})"


def terms(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{WORD}{{2,}}')"


def whole_word(text: str, alternatives: str) -> str:
    return f"regexp_matches({text}, {quoted(f'(?i)(^|{OTHER})({alternatives})({OTHER}|$)')})"


def signalled(source: str, keep: str) -> str:
    """`keep, signals` with the signals as a list."""
    dots = G.SARCASM_DOTS.replace(".", r"\.")
    lower_words = f"'^{SPACE}*(?:{NOT_SPACE}+{SPACE}+){{3}}{NOT_SPACE}'"
    emoji_class = "[\U0001F300-\U0001FAFF☀-➿\U0001F1E6-\U0001F1FF]"
    tests = {
        "emoji": f"regexp_matches(text, '{emoji_class}')",
        "elongation": "len(list_filter(ch, lambda x, i: i > 2 AND x <> chr(10) AND x = ch[i - 1] AND x = ch[i - 2])) > 0",
        "hashtag": "contains(text, '#')",
        "sarcasm": f"({whole_word('text', G.SARCASM_WORDS)} OR regexp_matches(text, '(?i)(^|{OTHER}){dots}{WORD}'))",
        "negation": whole_word("text", G.NEGATION_WORDS),
        "contrast": whole_word("text", G.CONTRAST_WORDS),
        "intensification": whole_word("text", G.INTENSIFIER_WORDS),
        "informal": f"({whole_word('text', G.INFORMAL_WORDS)} OR (text = lower(text) AND regexp_matches(text, {lower_words})))",
    }
    cases = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in tests.items())
    return (
        f"SELECT {keep}, list_filter([{cases}], lambda s: s IS NOT NULL) AS signals "
        f"FROM (SELECT *, string_split(text, '') AS ch FROM {source})"
    )


CATEGORY = "CASE WHEN len(signals) = 0 THEN 'other' WHEN len(signals) > 1 THEN 'mixed' ELSE signals[1] END"


def label_name(column: str) -> str:
    return f"CASE WHEN {column} = 0 THEN 'negative' ELSE 'positive' END"


# --- shared common tables ---------------------------------------------------------------------------

TRAIN = "train AS (SELECT * FROM tweets WHERE split = 'train')"
FOLDS = (
    f"folds AS (SELECT index, label, CAST((row_number() OVER (ORDER BY label, {H('index')}, index) - 1) % 3 AS INTEGER) AS fold FROM train)"
)
LABELLED = "labelled AS (SELECT d.doc_id AS index, d.text, l.quality AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"
SAMPLE = (
    f"ranked AS (SELECT index, label, row_number() OVER (PARTITION BY label ORDER BY {H('index')}, index) AS r FROM train),\n"
    f"shares AS (SELECT label, round_even(CAST({SAMPLE_FRACTION} AS DOUBLE) * count(*), 0) AS k FROM train GROUP BY label),\n"
    "sample AS (SELECT index, ranked.label AS label FROM ranked JOIN shares ON ranked.label = shares.label WHERE r <= k)"
)
CLEAN = f"clean AS (SELECT index, split, {clean_b0('text')} AS clean FROM tweets)"
COUNTS = f"counts AS (SELECT index, split, term, count(*) AS n FROM (SELECT index, split, unnest({terms('clean')}) AS term FROM clean) GROUP BY ALL)"
VOCABULARY = (
    "vocabulary AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_index "
    "FROM (SELECT DISTINCT term FROM counts WHERE split = 'train'))"
)
LEMMAS = (
    "lemmas AS (SELECT a.term AS form, b.term AS lemma FROM (SELECT DISTINCT term FROM counts) a "
    "JOIN (SELECT DISTINCT term FROM counts) b ON a.term = b.term || 's' WHERE length(a.term) >= 4)"
)


def lemmatized(tokens_source: str) -> str:
    """`(index, tokens)` with the lemmas joined by blanks; `tokens_source` has `(index, t)`."""
    return (
        "SELECT s.index, coalesce(string_agg(coalesce(l.lemma, p.form), ' ' ORDER BY p.pos), '') AS tokens "
        f"FROM {tokens_source} s LEFT JOIN (SELECT index, unnest(t) AS form, generate_subscripts(t, 1) AS pos FROM {tokens_source}) p "
        "ON s.index = p.index LEFT JOIN lemmas l ON p.form = l.form GROUP BY s.index"
    )


def tfidf(expression: str) -> str:
    """Fit on train, transform test, for the term list `expression` of `clean`."""
    body = """
SELECT index, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY index)), 6) AS value FROM (
  SELECT c.index, c.term, c.n * (ln((1 + t.texts) / (1 + f.df)) + 1) AS w
  FROM counts c JOIN frequencies f ON c.term = f.term, total t WHERE c.split = 'test')"""
    counts = f"counts AS (SELECT index, split, term, count(*) AS n FROM (SELECT index, split, unnest({expression}) AS term FROM clean) GROUP BY ALL)"
    frequencies = "frequencies AS (SELECT term, CAST(count(*) AS DOUBLE) AS df FROM counts WHERE split = 'train' GROUP BY term)"
    total = "total AS (SELECT CAST(count(*) AS DOUBLE) AS texts FROM tweets WHERE split = 'train')"
    return over("tweets", body, CLEAN, counts, frequencies, total)


def f1(counts: str) -> str:
    """`(fold, macro_f1)` of confusion counts `(fold, label, prediction, n)`."""
    return f"""
SELECT fold, avg(2.0 * hit / size) AS macro_f1 FROM (
  SELECT fold, c, sum(hit) AS hit, sum(n) AS size FROM (
    SELECT fold, label AS c, n, CASE WHEN label = prediction THEN n ELSE 0 END AS hit FROM {counts}
    UNION ALL SELECT fold, prediction AS c, n, 0 AS hit FROM {counts}) GROUP BY fold, c) GROUP BY fold"""


CONFUSION = "confusion AS (SELECT fold, label, prediction, count(*) AS n FROM predictions GROUP BY ALL)"
MAJORITY = """majority AS (SELECT fold, train_0, train_1, CASE WHEN train_0 >= train_1 THEN 0 ELSE 1 END AS majority FROM (
  SELECT k.fold, CAST(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS train_0, CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS train_1
  FROM (SELECT DISTINCT fold FROM folds) k JOIN folds f ON f.fold <> k.fold GROUP BY k.fold))"""
CATEGORISED = f"categorised AS (SELECT index, {CATEGORY} AS category FROM ({signalled('wrong', 'index')}))"
WRONG = "wrong AS (SELECT * FROM predictions WHERE label <> prediction)"
COUNTED = (
    "categories AS (SELECT CAST(u.pos - 1 AS INTEGER) AS position, u.category FROM (SELECT unnest(["
    + ", ".join(quoted(c) for c in G.CATEGORIES)
    + f"]) AS category, generate_subscripts([{', '.join(quoted(c) for c in G.CATEGORIES)}], 1) AS pos) u),\n"
    "counted AS (SELECT c.position, c.category, count(k.index) AS n FROM categories c LEFT JOIN categorised k ON c.category = k.category GROUP BY ALL)"
)
CHOSEN = f"""hashed AS (SELECT index, label, {H('index')} AS h FROM wrong),
first_ones AS (SELECT index, h FROM hashed QUALIFY row_number() OVER (PARTITION BY label ORDER BY h, index) = 1),
chosen AS (SELECT index FROM first_ones UNION ALL
  SELECT index FROM (SELECT index, row_number() OVER (ORDER BY h, index) AS r FROM hashed WHERE index NOT IN (SELECT index FROM first_ones))
  WHERE r <= greatest(20 - (SELECT count(*) FROM first_ones), 0))"""

# --- run log ----------------------------------------------------------------------------------------

VALID_EXPERIMENT = (
    "(status = 'FINISHED' AND lab_member_id IS NOT NULL AND macro_f1_fold_2 IS NOT NULL AND has_configuration = 1 AND has_provenance = 1)"
)
VALID_FINAL = (
    "(status = 'FINISHED' AND lab_member_id IS NOT NULL AND event_id % 53 <> 0 AND has_configuration = 1 AND has_provenance = 1)"
)
_BEFORE, _AFTER = json.dumps(V.run_configuration_template(), separators=(",", ":")).split('"K"')
CONFIGURATION = f"{quoted(_BEFORE)} || '\"' || (event_id % 20) || '\"' || {quoted(_AFTER)}"
GOOD_JSON = "event_id % 47 <> 0"
EXPERIMENTS = "experiments AS (SELECT * FROM runs_scored WHERE lab_run_type = 'experiment')"
ATTRIBUTED = (
    f"attributed AS (SELECT e.*, {VALID_EXPERIMENT} AS valid, coalesce(m.notebook_arn = e.notebook_arn, false) AS attributed, "
    "e.lab_experiment_id NOT IN ('T0', 'B0') AS counted FROM experiments e LEFT JOIN members m ON e.lab_member_id = m.member_id)"
)
ITEMS = """items AS (SELECT DISTINCT * FROM (
  SELECT lab_member_id AS member_id, notebook_arn, 'run_ids' AS list, run_id AS value FROM attributed WHERE valid AND attributed
  UNION ALL SELECT lab_member_id, notebook_arn, 'counted_run_ids', run_id FROM attributed WHERE valid AND attributed AND counted
  UNION ALL SELECT lab_member_id, notebook_arn, 'configuration_ids', lab_configuration_id FROM attributed WHERE valid AND attributed AND counted AND lab_configuration_id <> ''
  UNION ALL SELECT lab_member_id, notebook_arn, 'stages', lab_stage FROM attributed WHERE valid AND attributed AND counted))"""


# --- configurations ---------------------------------------------------------------------------------

NEGATOR_TEXT = quoted(",".join(NEGATORS))
OWN = {
    "stopwords": "stopwords",
    "negators": f"CASE WHEN has_negators = 1 THEN {NEGATOR_TEXT} ELSE '' END",
    "lemmatize": "lemmatize",
    "elongation": "elongation",
    "elongation_spec": "elongation_spec",
    "emoji": "emoji",
    "emoji_spec": "emoji_spec",
    "rep_type": "rep_type",
    "ngram_range": "CASE WHEN ngram_max IS NULL THEN '' ELSE '1,' || ngram_max END",
    "clf_type": "clf_type",
}
BASE = {
    "stopwords": "'keep'", "negators": "''", "lemmatize": "false", "elongation": "'keep'",
    "elongation_spec": "CAST(NULL AS VARCHAR)", "emoji": "'keep'", "emoji_spec": "CAST(NULL AS VARCHAR)",
    "rep_type": "'bow'", "ngram_range": "'1,1'", "clf_type": "'logistic_regression'",
}
PRE = ["stopwords", "negators", "lemmatize", "elongation", "elongation_spec", "emoji", "emoji_spec"]
REP = ["rep_type", "ngram_range"]


def configuration_rows(name: str, rows: list[tuple[dict[str, str], dict[str, str]]]) -> str:
    """One SELECT per variant: fixed columns and the configuration columns."""
    selects = []
    for fixed, fields in rows:
        columns = [f"{value} AS {column}" for column, value in [*fixed.items(), *fields.items()]]
        selects.append(f"SELECT config_key, {', '.join(columns)} FROM configs_flat")
    return over("configs_flat", "\nUNION ALL ".join(selects))


def grid() -> str:
    rows = []
    for tag in [*C.PREPROCESSING_TAGS, *C.REPRESENTATION_TAGS, *C.CLASSIFIER_TAGS]:
        stage = C.tag_stage(tag)
        fields = dict(BASE)
        if stage != "preprocessing":
            fields.update({f: OWN[f] for f in PRE})
        if stage == "classifier":
            fields.update({f: OWN[f] for f in REP})
            fields["clf_type"] = quoted(C.CLASSIFIER_TAGS[tag])
        if stage == "representation":
            kind, ngram_range = C.REPRESENTATION_TAGS[tag]
            fields["rep_type"], fields["ngram_range"] = quoted(kind), quoted(",".join(map(str, ngram_range)))
        if stage == "preprocessing":
            for field, value in C.PREPROCESSING_TAGS[tag].items():
                text = ",".join(value) if isinstance(value, list) else value
                fields[field] = str(text).lower() if isinstance(text, bool) else quoted(text)
        rows.append(({"tag": quoted(tag), "stage": quoted(stage)}, fields))
    return configuration_rows("grid", rows)


def reverts() -> str:
    touched = {
        "preprocessing.stopwords": ["stopwords", "negators"],
        "preprocessing.lemmatize": ["lemmatize"],
        "preprocessing.elongation": ["elongation", "elongation_spec"],
        "preprocessing.emoji": ["emoji", "emoji_spec"],
        "representation": REP,
        "classifier": ["clf_type"],
    }
    rows = [({"decision": quoted(d)}, {f: BASE[f] if f in touched[d] else own for f, own in OWN.items()}) for d in C.DECISIONS]
    return configuration_rows("reverts", rows)


def flags(tests: dict[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in tests.items())
    return f"array_to_string(list_filter([{cases}], lambda s: s IS NOT NULL), ',')"


VIOLATIONS = {
    "negators_missing": "stopwords = 'remove_preserve_negation' AND has_negators = 0",
    "negators_not_allowed": "stopwords <> 'remove_preserve_negation' AND has_negators = 1",
    "elongation_spec_missing": "elongation = 'normalize' AND elongation_spec IS NULL",
    "elongation_spec_not_allowed": "elongation = 'keep' AND elongation_spec IS NOT NULL",
    "emoji_spec_missing": "emoji = 'text' AND emoji_spec IS NULL",
    "emoji_spec_not_allowed": "emoji = 'keep' AND emoji_spec IS NOT NULL",
    "ngram_range_missing": "rep_type IN ('bow', 'tfidf') AND ngram_max IS NULL",
    "vector_method_missing": "rep_type = 'spacy_embedding' AND document_vector_method IS NULL",
    "representation_unknown": "rep_type NOT IN ('bow', 'tfidf', 'spacy_embedding')",
    "classifier_unknown": "clf_type NOT IN ('logistic_regression', 'linear_svm', 'sgd', 'most_frequent')",
}
DIFFERENCES = {
    "preprocessing.stopwords": "stopwords <> 'keep'",
    "preprocessing.lemmatize": "lemmatize",
    "preprocessing.elongation": "elongation <> 'keep'",
    "preprocessing.emoji": "emoji <> 'keep'",
    "representation": "rep_type <> 'bow' OR ngram_max IS NULL OR ngram_max <> 1",
    "classifier": "clf_type <> 'logistic_regression'",
}


LABEL_OF_MARGIN = "CASE WHEN coalesce(margin, 0) + 0.5 > 0 THEN 'positive' ELSE 'negative' END"


def fixed(asked: str, key: str) -> list[str]:
    """Margins of the texts of `asked` by the weights that the hash gives to the terms of train."""
    return [
        asked,
        f"weighted AS (SELECT term, {H('term')} % 7 - 3 AS weight FROM (SELECT DISTINCT unnest({terms(clean_b0('text'))}) AS term FROM train))",
        f"margins AS (SELECT {key}, sum(weight) AS margin FROM (SELECT {key}, unnest({terms(clean_b0('text'))}) AS term FROM asked) JOIN weighted USING (term) GROUP BY {key})",
    ]


# The slope of each loss at a margin of zero, times the sign of the label.
FIRST_SLOPE = {"logistic": "(0.5 - label)", "squared_hinge": "(2 - 4 * label)", "hinge": "(1 - 2 * label)"}
FOLD_TERMS = "fold_terms AS (SELECT c.index, f.fold, f.label, c.term, c.n FROM counts c JOIN folds f ON c.index = f.index)"
PLAIN_VALUES = "weighed AS (SELECT k.split, c.index, c.label, c.term AS feature, CAST(c.n AS DOUBLE) AS v FROM fold_terms c JOIN range(3) k(split) ON c.fold <> k.split)"
UNIT_VALUES = """outer_terms AS (SELECT k.split, c.index, c.label, c.term, c.n FROM fold_terms c JOIN range(3) k(split) ON c.fold <> k.split),
outer_df AS (SELECT split, term, CAST(count(*) AS DOUBLE) AS df FROM outer_terms GROUP BY ALL),
outer_texts AS (SELECT k.split, CAST(count(*) AS DOUBLE) AS texts FROM folds f JOIN range(3) k(split) ON f.fold <> k.split GROUP BY ALL),
weighed AS (SELECT split, index, label, term AS feature, w / sqrt(sum(w * w) OVER (PARTITION BY split, index)) AS v FROM (
  SELECT o.split, o.index, o.label, o.term, n * (ln((1 + texts) / (1 + df)) + 1) AS w FROM outer_terms o JOIN outer_df USING (split, term) JOIN outer_texts USING (split)))"""


def fit_proof(loss: str, *parts: str) -> str:
    """Rows, features and the gradient at zero weights of each fold, from `weighed`; a fit has to be optimal."""
    slope = FIRST_SLOPE[loss]
    return over(
        "tweets",
        f"""SELECT CAST(t.split AS INTEGER) AS fold, train_rows, (SELECT count(*) FROM folds) - train_rows AS validation_rows, features,
  round(sqrt(hh + s * s), 3) AS start_norm, true AS optimal
FROM (SELECT k.split, count(*) AS train_rows, sum({slope}) AS s FROM folds f JOIN range(3) k(split) ON f.fold <> k.split GROUP BY k.split) t
JOIN (SELECT split, count(*) AS features, sum(h * h) AS hh FROM (SELECT split, feature, sum(v * {slope}) AS h FROM weighed GROUP BY ALL) GROUP BY split) g ON t.split = g.split""",
        TRAIN, FOLDS, *parts,
    )


def model_proof(columns: str, weighed: str) -> str:
    """The same for one fit on all of train."""
    return over(
        "tweets",
        f"""SELECT {columns}, features, round(sqrt(hh + s * s), 3) AS start_norm, true AS optimal
FROM (SELECT count(*) AS training_size, sum(0.5 - label) AS s FROM train) t,
  (SELECT count(*) AS features, sum(h * h) AS hh FROM (SELECT feature, sum(v * (0.5 - label)) AS h FROM weighed GROUP BY feature)) g""",
        TRAIN, CLEAN, COUNTS,
        "own AS (SELECT c.index, t.label, c.term, c.n FROM counts c JOIN train t ON c.index = t.index)",
        weighed,
    )


def all_oracles() -> dict[str, str]:
    problem = (
        f"CASE WHEN text IS NULL THEN 'null_text' WHEN NOT regexp_matches(text, '{NOT_SPACE}') THEN 'blank_text' "
        f"WHEN length(text) > {scoring.MAX_CHARS} THEN 'long_text' END"
    )
    found: dict[str, str] = {}

    # sources, sinks, checks
    found["labelled_text"] = with_([LABELLED], "SELECT index, text, label FROM labelled")
    every = LABELLED.replace("labelled AS", "every AS").replace(" JOIN labels", " LEFT JOIN labels")
    found["source_profile"] = with_([every], """SELECT 'index,text,label' AS columns, count(*) AS n_rows,
  CAST(sum(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_texts, min(length(text)) AS min_length,
  max(length(text)) AS max_length, count(DISTINCT label) AS classes, count(*) - count(label) AS missing_labels,
  arg_min_null(text, index) AS example_text, arg_min_null(label, index) AS example_label FROM every""")
    found["check_row_count"] = (
        "SELECT 'documents' AS \"check\", CAST(1000 AS BIGINT) AS expected, count(*) AS actual, count(*) = 1000 AS ok FROM documents"
    )
    found["row_index"] = with_(
        [every], "SELECT index AS doc_id, label, row_number() OVER (ORDER BY every.index) - 1 AS index FROM every"
    )
    found["partitions_with_text"] = over(
        "tweets", "SELECT f.index, f.fold, l.text, l.label FROM folds f LEFT JOIN labelled l ON f.index = l.index", TRAIN, FOLDS, LABELLED
    )
    found["check_unmatched"] = over(
        "tweets", "SELECT count(*) AS unmatched FROM folds WHERE index NOT IN (SELECT index FROM labelled)", TRAIN, FOLDS, LABELLED
    )
    found["check_unique"] = "SELECT conv_id AS index, count(*) AS copies FROM conversations GROUP BY conv_id HAVING count(*) > 1"
    report = (
        f"SELECT w.index, w.text, {label_name('w.label')} AS true_label, {label_name('w.prediction')} AS predicted_label, "
        "k.category FROM wrong w JOIN categorised k ON w.index = k.index"
    )
    found["csv_roundtrip"] = over("predictions", report, WRONG, CATEGORISED)
    found["members_roundtrip"] = over("members", "SELECT member_id, notebook_arn FROM members")
    scores = ", ".join(f"max(CASE WHEN fold = {k} THEN macro_f1 END) AS f{k}" for k in range(3))
    experiment = lambda c: f"CASE WHEN lab_run_type = 'experiment' THEN round({c}, 6) END AS {c}"
    found["run_log_append"] = over(
        "runs_scored predictions",
        "SELECT run_id, status, lab_experiment_id AS experiment_id, "
        "CAST(has_configuration + has_provenance + CASE WHEN lab_run_type = 'final' THEN 2 ELSE 0 END AS BIGINT) AS artifacts, "
        + ", ".join(experiment(c) for c in R.EXPERIMENT_METRICS)
        + " FROM runs_scored UNION ALL SELECT 'run-new', 'FINISHED', 'EXTRA', 2, round(f0, 6), round(f1, 6), round(f2, 6), round(m, 6), round(s, 6) FROM new_scores",
        CONFUSION,
        f"scores AS ({f1('confusion')})",
        f"new_scores AS (SELECT {scores}, avg(macro_f1) AS m, stddev_pop(macro_f1) AS s FROM scores)",
    )

    # sampling and splits
    found["stratified_sample"] = over("tweets", "SELECT index, label FROM sample", TRAIN, SAMPLE)
    found["stratified_kfold"] = over("tweets", "SELECT index, label, fold FROM folds", TRAIN, FOLDS)
    found["fold_balance"] = over("tweets", "SELECT fold, label, count(*) AS n FROM folds GROUP BY fold, label", TRAIN, FOLDS)
    found["cv_splits"] = over(
        "tweets",
        "SELECT f.index, f.label, f.fold, CAST(k.split AS INTEGER) AS split, CASE WHEN f.fold = k.split THEN 'validation' ELSE 'train' END AS role "
        "FROM folds f, range(3) k(split)",
        TRAIN, FOLDS,
    )
    found["protocol_row"] = over(
        "tweets",
        "SELECT 'documents' AS dataset_id, 'seed-42' AS dataset_revision, 'stratified' AS sampling_strategy, count(*) AS sample_size, "
        "42 AS random_seed, 'StratifiedKFold' AS cv_strategy, 3 AS cv_folds, true AS cv_shuffle FROM sample",
        TRAIN, SAMPLE,
    )

    # text cleaning
    found["text_lower"] = over("tweets", "SELECT index, lower(text) AS lowered FROM tweets")
    found["text_urls"] = over("tweets", f"SELECT index, {urls('text')} AS token, {urls('text', '')} AS dropped, text AS kept FROM tweets")
    found["text_mentions"] = over("tweets", f"SELECT index, {mentions('text')} AS token, {mentions('text', '')} AS dropped FROM tweets")
    found["text_elongation"] = over("tweets", squeezed("tweets", "text", "index"))
    found["text_emoji"] = over("tweets", f"SELECT index, {emoji('text')} AS named FROM tweets")
    found["text_whitespace"] = over("tweets", f"SELECT index, {spaces('text')} AS normalized FROM tweets")
    token_rows = f"words AS (SELECT index, {words('text')} AS t FROM tweets)"
    found["tokens_words"] = over("tweets", "SELECT index, len(t) AS n, array_to_string(t, ' ') AS tokens FROM words", token_rows)
    found["stopwords_remove"] = over("tweets", f"SELECT index, array_to_string({without_stopwords('t')}, ' ') AS kept FROM words", token_rows)
    found["stopwords_keep_negation"] = over(
        "tweets", f"SELECT index, array_to_string({without_stopwords('t', NEGATORS)}, ' ') AS kept FROM words", token_rows
    )
    found["lemmatize"] = over(
        "tweets", lemmatized("words"), CLEAN, COUNTS, LEMMAS, f"words AS (SELECT index, {words('clean')} AS t FROM clean)"
    )
    prepared = f"prepared AS (SELECT index, {mentions(urls('lower(text)', ''))} AS text FROM tweets)"
    found["clean_text"] = over(
        "tweets",
        f"SELECT index, {spaces('tokens')} AS clean FROM done",
        CLEAN, COUNTS, LEMMAS, prepared,
        f"shorter AS ({squeezed('prepared', 'text', 'index')})",
        f"words AS (SELECT index, {without_stopwords(words(emoji('squeezed')), NEGATORS)} AS t FROM shorter)",
        f"done AS ({lemmatized('words')})",
    )
    found["clean_text_b0"] = over("tweets", f"SELECT index, {clean_b0('text')} AS clean FROM tweets")

    # representations
    found["vector_tokens"] = over(
        "tweets", f"SELECT index, len(t) AS n, array_to_string(t, ' ') AS tokens FROM (SELECT index, {terms('text')} AS t FROM tweets)"
    )
    bound = f"SELECT index, list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS g FROM (SELECT index, {terms('text')} AS t FROM tweets)"
    found["ngrams"] = over("tweets", f"SELECT index, len(g) AS n, array_to_string(g, '|') AS grams FROM ({bound})")
    found["vocabulary"] = over("tweets", "SELECT term, term_index FROM vocabulary", CLEAN, COUNTS, VOCABULARY)
    found["bow_unigram"] = over(
        "tweets",
        "SELECT c.index, c.term, v.term_index, c.n FROM counts c JOIN vocabulary v ON c.term = v.term WHERE c.split = 'test'",
        CLEAN, COUNTS, VOCABULARY,
    )
    found["tfidf_unigram"] = tfidf(terms("clean"))
    found["tfidf_uni_bi"] = tfidf("g").replace(
        "FROM clean) GROUP BY ALL",
        "FROM (SELECT index, split, list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS g "
        f"FROM (SELECT index, split, {terms('clean')} AS t FROM clean))) GROUP BY ALL",
    )
    found["tfidf_per_fold"] = over(
        "tweets",
        """SELECT split, index, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY index)), 6) AS value FROM (
  SELECT c.fold AS split, c.index, c.term, c.n * (ln((1 + t.texts) / (1 + f.df)) + 1) AS w
  FROM fold_counts c JOIN frequencies f ON c.term = f.term AND c.fold = f.split JOIN totals t ON t.split = c.fold)""",
        TRAIN, FOLDS, CLEAN, COUNTS,
        "fold_counts AS (SELECT c.index, f.fold, c.term, c.n FROM counts c JOIN folds f ON c.index = f.index)",
        "frequencies AS (SELECT k.split, c.term, CAST(count(*) AS DOUBLE) AS df FROM fold_counts c JOIN range(3) k(split) ON c.fold <> k.split GROUP BY ALL)",
        "totals AS (SELECT k.split, CAST(count(*) AS DOUBLE) AS texts FROM folds f JOIN range(3) k(split) ON f.fold <> k.split GROUP BY ALL)",
    )
    mean_vectors = [
        CLEAN, COUNTS,
        f"words AS (SELECT index, {words('clean')} AS t FROM clean)",
        "placed AS (SELECT embedding, row_number() OVER (ORDER BY vec_id) - 1 AS place FROM embeddings)",
        f"""vectors AS (SELECT v.term AS token, p.embedding AS vec FROM (SELECT DISTINCT term FROM counts WHERE regexp_matches(term, '^[a-z]+$')) v
  JOIN placed p ON p.place = {H('v.term')} % (SELECT count(*) FROM placed))""",
        """means AS (SELECT index, pos, avg(CAST(x AS DOUBLE)) AS value FROM (
  SELECT o.index, unnest(v.vec) AS x, generate_subscripts(v.vec, 1) - 1 AS pos
  FROM (SELECT index, unnest(t) AS token FROM words) o JOIN vectors v ON o.token = v.token) GROUP BY index, pos)""",
    ]
    found["mean_token_vectors"] = over(
        "tweets",
        """SELECT w.index, CAST(d.pos AS INTEGER) AS pos, round(coalesce(m.value, 0.0), 6) AS value
FROM words w CROSS JOIN range(64) d(pos) LEFT JOIN means m ON w.index = m.index AND d.pos = m.pos""",
        *mean_vectors,
    )

    # fits
    found["cv_logreg"] = fit_proof("logistic", CLEAN, COUNTS, FOLD_TERMS, PLAIN_VALUES)
    found["cv_linear_svm"] = fit_proof("squared_hinge", CLEAN, COUNTS, FOLD_TERMS, PLAIN_VALUES)
    found["cv_sgd"] = fit_proof("hinge", CLEAN, COUNTS, FOLD_TERMS, PLAIN_VALUES)
    found["run_configuration"] = fit_proof(
        "logistic", CLEAN, COUNTS.replace("counts AS", "plain_counts AS"), LEMMAS.replace("FROM counts", "FROM plain_counts"), prepared,
        f"shorter AS ({squeezed('prepared', 'text', 'index')})",
        f"words AS (SELECT index, {without_stopwords(words(emoji('squeezed')), NEGATORS)} AS t FROM shorter)",
        f"done AS ({lemmatized('words')})",
        f"counts AS (SELECT index, term, count(*) AS n FROM (SELECT index, unnest({terms(spaces('tokens'))}) AS term FROM done) GROUP BY ALL)",
        FOLD_TERMS, UNIT_VALUES,
    )
    found["run_configuration_vectors"] = fit_proof(
        "logistic", *mean_vectors,
        """weighed AS (SELECT k.split, f.index, f.label, d.pos AS feature, coalesce(m.value, 0.0) AS v
  FROM folds f JOIN range(3) k(split) ON f.fold <> k.split CROSS JOIN range(64) d(pos) LEFT JOIN means m ON f.index = m.index AND d.pos = m.pos)""",
    )
    found["predict_fitted"] = model_proof(
        "training_size, (SELECT count(*) FROM tweets WHERE split = 'test') AS labelled",
        """own_df AS (SELECT term, CAST(count(*) AS DOUBLE) AS df FROM own GROUP BY term),
weighed AS (SELECT label, term AS feature, w / sqrt(sum(w * w) OVER (PARTITION BY index)) AS v FROM (
  SELECT index, label, term, n * (ln((1 + CAST((SELECT count(*) FROM train) AS DOUBLE)) / (1 + df)) + 1) AS w FROM own JOIN own_df USING (term)))""",
    )
    found["final_model"] = model_proof("'run-final' AS run_id, training_size", "weighed AS (SELECT label, term AS feature, CAST(n AS DOUBLE) AS v FROM own)")

    # scores
    found["majority_per_fold"] = over("tweets", "SELECT * FROM majority", TRAIN, FOLDS, MAJORITY)
    found["confusion_per_fold"] = over("predictions", "SELECT fold, label, prediction, n FROM confusion", CONFUSION)
    found["macro_f1_per_fold"] = over("predictions", "SELECT fold, round(macro_f1, 6) AS macro_f1 FROM scores", CONFUSION, f"scores AS ({f1('confusion')})")
    found["score_summary"] = over(
        "predictions",
        "SELECT round(avg(macro_f1), 6) AS macro_f1_mean, round(stddev_pop(macro_f1), 6) AS macro_f1_std FROM scores",
        CONFUSION, f"scores AS ({f1('confusion')})",
    )
    found["t0_scores"] = over(
        "tweets", "SELECT fold, round(macro_f1, 6) AS macro_f1 FROM scores", TRAIN, FOLDS, MAJORITY,
        "guessed AS (SELECT f.fold, f.label, m.majority AS prediction, count(*) AS n FROM folds f JOIN majority m ON f.fold = m.fold GROUP BY ALL)",
        f"scores AS ({f1('guessed')})",
    )

    # configurations and ablation
    found["comparison_grid"] = grid()
    found["validate_configs"] = over("configs_flat", f"SELECT config_key, {flags(VIOLATIONS)} AS violations FROM configs_flat")
    found["config_conflicts"] = over(
        "runs_flat",
        """SELECT 'configuration_with_ids' AS kind, hash AS value, count(*) AS n FROM pairs GROUP BY hash HAVING count(*) > 1
UNION ALL SELECT 'id_with_configurations', id, count(*) FROM pairs GROUP BY id HAVING count(*) > 1""",
        f"pairs AS (SELECT DISTINCT lab_configuration_id AS id, sha256({CONFIGURATION}) AS hash FROM runs_flat WHERE lab_configuration_id <> '' AND {GOOD_JSON})",
    )
    found["revert_decision"] = reverts()
    decisions = ", ".join(f"CASE WHEN {test} THEN 1 ELSE 0 END" for test in DIFFERENCES.values())
    found["ablation_plan"] = over(
        "configs_flat",
        f"SELECT config_key, {flags(DIFFERENCES)} AS decisions, CAST(least(2, list_sum([{decisions}])) AS INTEGER) AS required FROM configs_flat",
    )
    found["ablation_delta"] = over(
        "runs_scored",
        """SELECT a.run_id, a.lab_ablation_parent_run_id AS parent_run_id, round(p.macro_f1_mean - a.macro_f1_mean, 6) AS macro_f1_delta,
  CASE WHEN p.macro_f1_mean IS NULL THEN 'parent_without_mean' ELSE 'ok' END AS status
FROM experiments a LEFT JOIN experiments p ON a.lab_ablation_parent_run_id = p.run_id WHERE a.lab_ablation_parent_run_id IS NOT NULL""",
        EXPERIMENTS,
    )
    found["leaderboard"] = over(
        "runs_scored",
        """SELECT lab_stage AS stage, run_id, lab_configuration_id AS configuration_id, round(macro_f1_mean, 6) AS macro_f1_mean
FROM experiments WHERE macro_f1_mean IS NOT NULL QUALIFY row_number() OVER (PARTITION BY lab_stage ORDER BY macro_f1_mean DESC, run_id) = 1""",
        EXPERIMENTS,
    )

    # error analysis
    found["misclassified"] = over("predictions", "SELECT index, fold, text, label, prediction FROM wrong", WRONG)
    found["select_errors"] = over("predictions", "SELECT index FROM chosen", WRONG, CHOSEN)
    found["error_signals"] = over("tweets", f"SELECT index, array_to_string(signals, ',') AS signals FROM ({signalled('tweets', 'index')})")
    found["error_category"] = over("tweets", f"SELECT index, {CATEGORY} AS category FROM ({signalled('tweets', 'index')})")
    found["category_counts_of_all_errors"] = over("predictions", "SELECT position, category, n FROM counted", WRONG, CATEGORISED, COUNTED)
    of_report = COUNTED.replace("LEFT JOIN categorised k", "LEFT JOIN (SELECT * FROM categorised WHERE index IN (SELECT index FROM chosen)) k")
    found["category_counts"] = over("predictions", "SELECT position, category, n FROM counted", WRONG, CATEGORISED, CHOSEN, of_report)
    found["top_categories"] = over(
        "predictions", "SELECT position, category, n FROM counted WHERE n > 0 ORDER BY n DESC, position LIMIT 2", WRONG, CATEGORISED, CHOSEN, of_report
    )
    found["error_report"] = over(
        "predictions", report + " WHERE w.index IN (SELECT index FROM chosen)", WRONG, CATEGORISED, CHOSEN
    )

    # run-log audit
    found["presented_runs"] = over("runs_flat", "SELECT run_id, lab_run_type AS run_type FROM runs_flat WHERE lab_run_type IS NOT NULL")
    text = {k: quoted(v) for k, v in V.PROTOCOL.items()}
    found["protocol_audit"] = over(
        "runs_flat",
        f"""SELECT min(run_id) AS protocol_run_id, {text['dataset_id']} AS dataset_id, {text['dataset_revision']} AS dataset_revision,
  {text['sampling_strategy']} AS sampling_strategy, CAST({text['sample_size']} AS BIGINT) AS sample_size, CAST({text['random_seed']} AS BIGINT) AS random_seed,
  {text['cv_strategy']} AS cv_strategy, CAST({text['cv_folds']} AS BIGINT) AS cv_folds, {text['cv_shuffle']} = 'True' AS cv_shuffle,
  'protocol/partitions.csv' AS partitions_artifact, 'protocol/members.csv' AS members_artifact
FROM runs_flat WHERE lab_run_type = 'protocol' HAVING count(*) = 1""",
    )
    tag_count = (
        "5 + CASE WHEN lab_run_type IS NULL THEN 0 ELSE 1 END + CASE WHEN lab_member_id IS NULL THEN 0 ELSE 1 END "
        "+ CASE WHEN lab_run_type = 'final' THEN 1 ELSE 0 END "
        "+ CASE WHEN lab_run_type = 'experiment' AND lab_ablation_parent_run_id IS NOT NULL THEN 1 ELSE 0 END"
    )
    metric_count = (
        "CASE lab_run_type WHEN 'final' THEN 1 WHEN 'experiment' THEN CASE WHEN macro_f1_fold_2 IS NULL THEN 2 "
        "WHEN lab_ablation_parent_run_id IS NULL THEN 5 ELSE 6 END ELSE 0 END"
    )
    param_count = f"CASE WHEN lab_run_type = 'protocol' THEN {len(V.PROTOCOL)} WHEN lab_run_type = 'final' AND event_id % 53 <> 0 THEN 1 ELSE 0 END"
    artifacts = flags({
        R.EXPERIMENT_ARTIFACTS[1]: "has_provenance = 1",
        R.FINAL_ARTIFACTS[2]: "lab_run_type = 'final'",
        R.FINAL_ARTIFACTS[3]: "lab_run_type = 'final'",
        R.CONFIGURATION_ARTIFACT: "has_configuration = 1",
    })
    found["runs_audit"] = over(
        "runs_flat",
        f"""SELECT run_id, status, lab_run_type AS run_type, CAST({param_count} AS BIGINT) AS params, CAST({metric_count} AS BIGINT) AS metrics,
  CAST({tag_count} AS BIGINT) AS tags, {artifacts} AS artifacts,
  CASE WHEN lab_run_type IN ('experiment', 'final') AND has_configuration = 1 AND {GOOD_JSON} THEN {CONFIGURATION} END AS configuration
FROM runs_flat WHERE lab_run_type IS NOT NULL""",
    )
    found["valid_experiment"] = over("runs_flat", f"SELECT run_id, {VALID_EXPERIMENT} AS valid FROM runs_flat WHERE lab_run_type = 'experiment'")
    found["valid_final"] = over("runs_flat", f"SELECT run_id, {VALID_FINAL} AS valid FROM runs_flat WHERE lab_run_type = 'final'")
    audited = [EXPERIMENTS, ATTRIBUTED]
    found["attribute_runs"] = over(
        "runs_scored members", "SELECT run_id, valid, lab_member_id AS member_id, notebook_arn, attributed FROM attributed", *audited
    )
    count = lambda name, out: f"CAST(sum(CASE WHEN list = '{name}' THEN 1 ELSE 0 END) AS BIGINT) AS {out}"
    found["contributions"] = over(
        "runs_scored members",
        f"SELECT member_id, notebook_arn, {count('run_ids', 'runs')}, {count('counted_run_ids', 'counted_runs')}, "
        f"{count('configuration_ids', 'valid_configurations')}, {count('stages', 'stages')} FROM items GROUP BY member_id, notebook_arn",
        *audited, ITEMS,
    )
    found["contribution_items"] = over("runs_scored members", "SELECT member_id, notebook_arn, list, value FROM items", *audited, ITEMS)
    found["rejected_runs"] = over(
        "runs_scored members",
        "SELECT run_id, true AS invalid, valid AS unattributed FROM attributed WHERE NOT (valid AND attributed)",
        *audited,
    )
    found["contribution_minimum"] = over(
        "runs_scored",
        """SELECT *, valid_configurations >= 3 AND stages >= 2 AS meets_minimum FROM (
  SELECT lab_member_id AS member_id, count(DISTINCT nullif(lab_configuration_id, '')) AS valid_configurations, count(DISTINCT lab_stage) AS stages
  FROM experiments WHERE lab_member_id IS NOT NULL AND lab_experiment_id NOT IN ('T0', 'B0') GROUP BY lab_member_id)""",
        EXPERIMENTS,
    )
    found["experiment_table"] = over(
        "runs_scored",
        """SELECT run_id, lab_experiment_id, lab_stage, lab_member_id, lab_configuration_id, round(macro_f1_mean, 6) AS macro_f1_mean,
  round(macro_f1_std, 6) AS macro_f1_std,
  CASE WHEN lab_ablation_parent_run_id IS NOT NULL THEN round(macro_f1_fold_0 - macro_f1_mean, 6) END AS macro_f1_delta FROM experiments""",
        EXPERIMENTS,
    )
    newest = "newest AS (SELECT name, max(version) AS version, arg_max(run_id, version) AS run_id FROM models WHERE alias = 'champion' GROUP BY name)"
    found["champion"] = over("models", "SELECT name, version, run_id FROM newest", newest)
    shown = {
        "protocol_run_id": "r.lab_protocol_run_id", "selected_experiment_run_id": "r.previous_run_id",
        "configuration_id": "r.lab_configuration_id", "configuration": CONFIGURATION,
        "training_size": "CAST(1000 AS BIGINT)", "test_macro_f1": "round(r.macro_f1_fold_0, 6)",
    }
    good = f"{VALID_FINAL} AND {GOOD_JSON}"
    found["champion_audit"] = over(
        "models",
        f"""SELECT w.name, CASE WHEN n.version IS NULL THEN 'champion_not_found' WHEN {good} THEN 'ok' ELSE 'champion_invalid' END AS status,
  n.version, n.run_id, {', '.join(f"CASE WHEN {good} THEN {value} END AS {name}" for name, value in shown.items())}
FROM (SELECT DISTINCT name FROM models UNION ALL SELECT 'model_5') w LEFT JOIN newest n ON w.name = n.name LEFT JOIN runs_flat r ON n.run_id = r.run_id""",
        newest,
    )

    # request scoring
    found["validate_texts"] = over(
        "requests", f"SELECT request_id, pos, reason IS NULL AS ok, reason FROM (SELECT request_id, pos, {problem} AS reason FROM requests)"
    )
    found["validate_requests"] = over(
        "requests request_list",
        f"""SELECT request_id, texts, reason IS NULL AS ok, reason FROM (
  SELECT request_id, texts, CASE WHEN texts = 0 THEN 'no_text' WHEN texts > {scoring.MAX_TEXTS} THEN 'too_many_texts' WHEN bad > 0 THEN 'bad_text' END AS reason FROM (
    SELECT l.request_id, count(c.request_id) AS texts, count(c.reason) AS bad
    FROM request_list l LEFT JOIN (SELECT request_id, {problem} AS reason FROM requests) c ON l.request_id = c.request_id GROUP BY l.request_id))""",
    )

    # scoring with fixed weights
    found["predict_labels"] = over("tweets", f"SELECT index, {LABEL_OF_MARGIN} AS predicted_label FROM asked LEFT JOIN margins USING (index)", TRAIN, *fixed("asked AS (SELECT index, text FROM tweets WHERE split = 'test')", "index"))
    good = f"asked AS (SELECT request_id, pos, text FROM (SELECT *, {problem} AS reason FROM requests) WHERE reason IS NULL)"
    labelled = f"scored AS (SELECT request_id, pos, {LABEL_OF_MARGIN} AS label FROM asked LEFT JOIN margins USING (request_id, pos))"
    accepted = f"accepted AS (SELECT request_id FROM (SELECT request_id, {problem} AS reason FROM requests) GROUP BY request_id HAVING count(*) <= {scoring.MAX_TEXTS} AND count(reason) = 0)"
    found["score_requests"] = over(
        "tweets requests request_list",
        """SELECT request_id, 'run-final' AS model_run_id, string_agg(label, ',' ORDER BY pos) AS predictions
FROM scored WHERE request_id IN (SELECT request_id FROM accepted) AND request_id IN (SELECT request_id FROM request_list) GROUP BY request_id""",
        TRAIN, *fixed(good, "request_id, pos"), labelled, accepted,
    )
    found["score_stream"] = over(
        "tweets requests models",
        f"""SELECT request_id, pos, (SELECT arg_max(run_id, version) FROM models WHERE name = '{SERVED}' AND alias = 'champion') AS model_run_id, label AS outcome FROM scored
UNION ALL SELECT request_id, pos, NULL, reason FROM (SELECT *, {problem} AS reason FROM requests) WHERE reason IS NOT NULL""",
        TRAIN, *fixed(good, "request_id, pos"), labelled,
    )
    return found
