"""SQL for the same results, written from the rules and not from the plans: checked by another engine.

Every helper takes and gives a SQL expression. RE2 has neither lookaround nor references back, so some rules are said in
another way than in the column functions.
"""

from __future__ import annotations

WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
EDGE = r"[.,;:\-\s\x0b\x1c-\x1f\x85\p{Z}]+"
SPECIAL = r"[#@%^&*=+{}<>|~`$]"
NA = ", ".join(f"'{x}'" for x in ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"))


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, 'g')"


def strip(x):
    return sub(x, rf"\A{WS}+|{WS}+\z")


def squeeze(x):
    return sub(x, WS + "+", " ")


def zero_width(x):
    return strip(sub(x, r"[\x{200B}-\x{200D}\x{FEFF}]"))


def commas(x):
    return sub(sub(x, WS + "+,", ","), "," + WS + "*", ", ")


def standardize(x):
    return strip(commas(squeeze(strip(x))))


def fix_format(x):
    return sub(squeeze(commas(x)), r"\A[ ,]+|[ ,]+\z")


def tight(x):
    return sub(x, WS + "+([.,;:!?])", r"\1")


def first_mark(x):
    return sub(x, "([.,;:!?])[.,;:!?]+", r"\1")


def without(x, words):
    for w in words:
        x = f"replace({x}, {q(w)}, '')"
    return x


ABBR = ("adj.", "adv.", "v.", "n.", "s.", "pron.", "prep.", "conj.", "interj.", "aux.")


def fold(x):
    return f"replace(lower({x}), 'ß', 'ss')"


def improve_text(x):
    return strip(tight(sub(squeeze(strip(x)), ",+", ",")))


def improve_noise(x):
    x = without(x, ABBR)
    # A mark on both sides of whatever is no word character lets neighbours share it.
    x = sub(x, r"([^\p{L}\p{N}_])", "\x01\\1\x01")
    x = sub(x, "(^|\x01)[A-Z](\x01|$)", r"\1\2")
    x = f"replace({x}, '\x01', '')"
    x = sub(x, WS + r"+[A-Za-z]+\z")
    return strip(sub(sub(squeeze(x), r"\A[.,;: ]+"), r"[.,;: ]+\z"))


def response_v1(x):
    x = without(strip(x), (*ABBR, "cf."))
    x = f"array_to_string(list_filter(string_split({x}, ' '), lambda t: NOT regexp_matches(t, '[A-Za-z]')), ' ')"
    x = tight(first_mark(x))
    x = sub(x, r"([.,;:!?])([^\s\x0b\x1c-\x1f\x85\p{Z}.,;:!?])", r"\1 \2")
    x = first_mark(squeeze(x))
    return strip(sub(sub(x, r"\A" + EDGE), EDGE + r"\z"))


def instruction_v1(x):
    return strip(squeeze(first_mark(strip(x))))


def response_v2(x):
    x = without(strip(x), (*ABBR, "cf."))
    x = f"array_to_string(list_filter(regexp_split_to_array({strip(x)}, {q(WS + '+')}), lambda t: NOT regexp_matches(t, '[A-Za-z]')), ' ')"
    x = f"replace(replace({x}, 'ಪಾ ರುಪತ್ಯ್ಯ', 'ಪಾರುಪತ್ಯ್ಯ'), 'ಪ್ರಮಾಣಪೂರ್ವಕಾ ದ್', 'ಪ್ರಮಾಣಪೂರ್ವಕಾದ್')"
    return strip(tight(squeeze(first_mark(x))))


def instruction_v2(x):
    return strip(tight(squeeze(first_mark(strip(x)))))


def na(x):
    return f"CASE WHEN {x} NOT IN ({NA}) THEN {x} END"


def parts(x):
    return f"list_filter(list_transform(string_split({x}, ','), lambda p: {strip('p')}), lambda p: p <> '')"


def ordered_distinct(a):
    return f"list_filter({a}, lambda p, i: list_position({a}, p) = i)"


def repeated(x):
    return f"regexp_matches({x}, '\\.{{2,}}|,{{2,}}|;{{2,}}|:{{2,}}|!{{2,}}|\\?{{2,}}')"


def abbreviation(x):
    return f"regexp_matches({x}, '(?i)(^|[^\\p{{L}}\\p{{N}}_])(adj|adv|pron|prep|conj|interj|aux|cf)\\.')"


def latin(x):
    return f"regexp_matches({x}, '[A-Za-z]')"


CLEAN = f"""
WITH s AS (SELECT entry_id AS pos, {na("english")} AS e, {na("tulu")} AS t FROM clean_dictionary),
c AS (SELECT pos, {zero_width(squeeze(strip("e")))} AS english, {zero_width(squeeze(strip("t")))} AS tulu FROM s WHERE e IS NOT NULL AND t IS NOT NULL),
f AS (SELECT min(pos) AS pos, english, tulu FROM c GROUP BY english, tulu HAVING english <> '' AND tulu <> '')
SELECT row_number() OVER (ORDER BY pos) - 1 AS row_index, english, tulu FROM f
"""
STANDARD = f"""
WITH s AS (SELECT entry_id AS pos, {standardize(f"coalesce({na('english')}, 'nan')")} AS english, {standardize(f"coalesce({na('tulu')}, 'nan')")} AS tulu FROM clean_dictionary)
SELECT min(pos) AS pos, english, tulu FROM s GROUP BY english, tulu
"""
_RULES = (
    (1, "English", "e", "e = '' OR lower(e) = 'nan'", "Missing Value", "Fill the missing English word", "High"),
    (2, "Tulu", "t", "t = '' OR lower(t) = 'nan'", "Missing Value", "Fill the missing Tulu meaning", "High"),
    (3, "Tulu", "t", latin("t"), "English Found in Tulu", "Review manually", "Low"),
    (4, "English", "e", r"regexp_matches(e, '\p{Nd}')", "Digits Found", "Remove digits", "Medium"),
    (5, "Tulu", "t", r"regexp_matches(t, '\p{Nd}')", "Digits Found", "Remove digits", "Medium"),
    (6, "Tulu", "t", f"regexp_matches(t, '{SPECIAL}')", "Special Character", "Remove special character", "Medium"),
    (7, "Tulu", "t", f"len({parts('t')}) <> len(list_distinct({parts('t')}))", "Duplicate Meaning", "Keep one occurrence", "Medium"),
    (8, "Tulu", "t", "contains(t, ',,')", "Consecutive Commas", "Replace with single comma", "Medium"),
    (9, "Tulu", "t", f"regexp_matches(t, '{WS}{{2,}}')", "Multiple Spaces", "Replace with single space", "Low"),
)
_ISSUES = (
    f"WITH s AS (SELECT entry_id + 2 AS row_no, {strip(f'coalesce({na("english")}, {q("nan")})')} AS e, {strip(f'coalesce({na("tulu")}, {q("nan")})')} AS t FROM clean_dictionary), i AS ("
    + " UNION ALL ".join(f"SELECT row_no, {n} AS rule_no, '{col}' AS column_name, {v} AS original_value, '{name}' AS issue, '{fix}' AS suggested_fix, '{sev}' AS severity FROM s WHERE {cond}" for n, col, v, cond, name, fix, sev in _RULES)
    + ") "
)
ISSUES = _ISSUES + "SELECT * FROM i"
ISSUE_SUMMARY = _ISSUES + "SELECT issue, count(*) AS rows FROM i GROUP BY issue"
SEVERITY_SUMMARY = _ISSUES + "SELECT severity, count(*) AS rows FROM i GROUP BY severity"

_FIXES = (("d_t", sub("t", r"\p{Nd}+")), ("s_t", sub("t", SPECIAL)), ("m_t", f"array_to_string({ordered_distinct(parts('t'))}, ', ')"), ("c_t", sub("t", ",+", ",")))


def _fold(source: str) -> str:
    out, last = "", source
    for k, (flag, done) in enumerate(_FIXES):
        out += f", f{k} AS (SELECT * EXCLUDE (t), CASE WHEN {flag} THEN {fix_format(done)} ELSE t END AS t FROM {last})"
        last = f"f{k}"
    return out, last


_AFTER, _LAST = _fold("g")
FIXED = f"""
WITH s AS (SELECT entry_id AS pos, coalesce({na("english")}, 'nan') AS e, coalesce({na("tulu")}, 'nan') AS t FROM clean_dictionary),
b AS (SELECT *, {strip("t")} AS st FROM s),
g AS (SELECT pos, CASE WHEN regexp_matches(e, '\\p{{Nd}}') THEN {fix_format(sub("e", r"\p{Nd}+"))} ELSE e END AS e, t, regexp_matches(st, '\\p{{Nd}}') AS d_t, regexp_matches(st, '{SPECIAL}') AS s_t,
  len({parts("st")}) <> len(list_distinct({parts("st")})) AS m_t, contains(st, ',,') AS c_t FROM b){_AFTER}
SELECT min(pos) AS pos, e AS english, t AS tulu FROM {_LAST} WHERE {strip("e")} <> '' AND {strip("t")} <> '' GROUP BY e, t
"""
REPORT_FIXED = f"""
WITH r AS (SELECT row_no - 2 AS pos, bool_or(column_name = 'English' AND issue = 'Digits Found') AS d_e, bool_or(column_name = 'Tulu' AND issue = 'Digits Found') AS d_t, bool_or(column_name = 'Tulu' AND issue = 'Special Character') AS s_t,
  bool_or(column_name = 'Tulu' AND issue = 'Duplicate Meaning') AS m_t, bool_or(column_name = 'Tulu' AND issue = 'Consecutive Commas') AS c_t FROM validation_report WHERE severity <> 'Low' GROUP BY 1),
g AS (SELECT entry_id AS pos, CASE WHEN d_e THEN {fix_format(sub("english", r"\p{Nd}+"))} ELSE english END AS e, tulu AS t, d_t, s_t, m_t, c_t FROM clean_dictionary LEFT JOIN r ON r.pos = entry_id){_AFTER}
SELECT pos, e AS english, t AS tulu FROM {_LAST}
"""
_ENTRIES = f"""
WITH s AS (SELECT entry_id AS pos, {na("english")} AS e, {na("tulu")} AS t FROM clean_dictionary),
k AS (SELECT *, row_number() OVER (PARTITION BY e ORDER BY pos) AS n FROM s WHERE e IS NOT NULL AND t IS NOT NULL),
m AS (SELECT pos, {strip("e")} AS english, {parts(strip("t"))} AS m FROM k WHERE n = 1)
"""
PAIRS = _ENTRIES + """, p AS (
  SELECT pos, 0 AS template_no, 'Translate ''' || english || ''' to Tulu.' AS instruction, m[1] AS response FROM m WHERE len(m) > 0
  UNION ALL SELECT pos, 1, 'What is the Tulu meaning of ' || english || '?', array_to_string(m, ', ') FROM m WHERE len(m) > 0
  UNION ALL SELECT pos, 2, 'How do you say ' || english || ' in Tulu?', m[1] FROM m WHERE len(m) > 0
  UNION ALL SELECT pos, 3, 'Give the Tulu translation of ' || english || '.', m[1] FROM m WHERE len(m) > 0
  UNION ALL SELECT pos, 4, 'Tulu word for ' || english || '.', m[1] FROM m WHERE len(m) > 0)
"""
NO_MEANING = _ENTRIES.replace("FROM clean_dictionary", """FROM (SELECT * REPLACE (CASE WHEN contains(tulu, '/') THEN ' , ,' ELSE tulu END AS tulu) FROM clean_dictionary)""") + "SELECT pos, english, 'No meaning' AS reason FROM m WHERE len(m) = 0"
_CONVERSATIONS = f"""c AS (SELECT min(conv_id) AS pos, {strip("tulu_text")} AS instruction, {strip("response_tulu")} AS response FROM raw_conversations WHERE tulu_text IS NOT NULL AND response_tulu IS NOT NULL GROUP BY tulu_text, response_tulu)"""
CONVERSATIONS = f"WITH {_CONVERSATIONS} SELECT pos, instruction, response FROM c"
_MERGED = PAIRS + f", {_CONVERSATIONS}, u AS (SELECT 0 AS src_order, pos * 5 + template_no AS pos, instruction, response FROM p UNION ALL SELECT 1, pos, instruction, response FROM c)"
MERGED = _MERGED + "SELECT *, md5('42|' || src_order || '|' || pos || '|' || instruction) AS shuffle_key FROM u"

_TRAIN = "WITH s AS (SELECT record_id AS pos, coalesce(instruction, '') AS i, coalesce(response, '') AS r FROM train)"
_IMPROVED = f"""{_TRAIN}, x AS (SELECT pos, r AS raw, {improve_text("i")} AS instruction, {improve_noise(improve_text("r"))} AS response FROM s),
k AS (SELECT *, row_number() OVER (PARTITION BY instruction, response ORDER BY pos) AS n FROM x WHERE instruction <> '' AND response <> '')
"""
IMPROVED = _IMPROVED + "SELECT pos, instruction, response, response <> raw AS modified FROM k WHERE n = 1"
IMPROVE_REPORT = _IMPROVED + f"""SELECT (SELECT count(*) FROM s) AS records, count(*) FILTER (n = 1) AS kept, count(*) FILTER (n = 1 AND response <> raw) AS modified,
(SELECT count(*) FROM x WHERE instruction = '' OR response = '') AS dropped_empty, count(*) FILTER (n > 1) AS duplicates_removed, least(count(*) FILTER (n = 1 AND {latin("response")}), 20) AS latin_left FROM k"""


def _filter(version: int) -> str:
    clean_i, clean_r = (instruction_v1, response_v1) if version == 1 else (instruction_v2, response_v2)
    if version == 1:
        reason, dup = "CASE WHEN instruction = '' OR length(cleaned_response) < 2 THEN 'Empty or too short after cleaning' END", "Duplicate after cleaning"
    else:
        words = ", ".join(f"'{w}'" for w in ("ಿ", "ಾ", "ು", "ೂ", "ೆ", "ೇ", "ೈ", "ೊ", "ೋ", "ೌ", "ಓ", "ಗೆ", "ಗಿ", "ತಿ", "ಗ", "ದ", "ಕ್"))
        compact = "replace(cleaned_response, ' ', '')"
        reason = f"CASE WHEN instruction = '' THEN 'Empty instruction' WHEN length({compact}) < 3 OR {compact} IN ({words}) OR regexp_matches({compact}, '\\A[\\x{{0CCD}}-\\x{{0CE3}}]+\\z') THEN 'OCR garbage / too short' END"
        dup = "Duplicate"
    return f"""{_TRAIN}, x AS (SELECT pos, i, r, {clean_i("i")} AS instruction, {clean_r("r")} AS cleaned_response FROM s),
y AS (SELECT *, {reason} AS bad FROM x),
z AS (SELECT *, coalesce(bad, CASE WHEN row_number() OVER (PARTITION BY bad IS NULL, {fold("instruction")}, {fold("cleaned_response")} ORDER BY pos) = 1 THEN 'Kept' ELSE '{dup}' END) AS reason FROM y)
"""


def _filter_report(version: int) -> str:
    raw = strip("r") if version == 1 else "r"
    return _filter(version) + f"""SELECT count(*) AS records, count(*) FILTER (reason = 'Kept') AS kept, count(*) FILTER (reason LIKE 'Duplicate%') AS duplicates, count(*) FILTER (reason <> 'Kept' AND reason NOT LIKE 'Duplicate%') AS rejected,
count(*) FILTER (reason = 'Kept' AND cleaned_response <> {raw}) AS modified, count(*) FILTER (reason = 'Kept' AND {latin("cleaned_response")}) AS latin_left, count(*) FILTER (reason = 'Kept' AND {repeated("cleaned_response")}) AS repeated_marks_left FROM z"""


KEPT_1, KEPT_2 = (_filter(v) + "SELECT pos, instruction, cleaned_response AS response FROM z WHERE reason = 'Kept'" for v in (1, 2))
REMOVED_1 = _filter(1) + "SELECT pos, i AS instruction, r AS response, cleaned_response, reason FROM z WHERE reason <> 'Kept'"
REMOVED_2 = _filter(2) + "SELECT pos, i AS instruction, r AS response, reason FROM z WHERE reason <> 'Kept'"
REPORT_1, REPORT_2 = _filter_report(1), _filter_report(2)

_CHECKED = f"WITH x AS (SELECT record_id AS pos, {strip('coalesce(instruction, {})'.format(q('')))} AS instruction, {strip('coalesce(response, {})'.format(q('')))} AS response FROM train), "
_CHECKED += f"d AS (SELECT *, row_number() OVER (PARTITION BY {fold('instruction')}, {fold('response')} ORDER BY pos) > 1 AS is_duplicate FROM x) "
DUPLICATES = _CHECKED + "SELECT pos, is_duplicate FROM d"
SUSPICIOUS = _CHECKED + f""", w AS (SELECT pos, instruction, response, list_filter([CASE WHEN {latin("response")} THEN 'Contains English/Latin characters' END, CASE WHEN {abbreviation("response")} THEN 'Contains dictionary abbreviation' END,
CASE WHEN {repeated("response")} THEN 'Contains repeated punctuation' END], lambda v: v IS NOT NULL) AS reasons FROM d) SELECT * FROM w WHERE len(reasons) > 0"""
VALIDATION = _CHECKED + f""", v AS (SELECT count(*) AS records, count(*) FILTER (instruction = '') AS empty_instruction, count(*) FILTER (response = '') AS empty_response, count(*) FILTER (length(instruction) = 1) AS short_instruction,
0 AS short_response, count(*) FILTER (length(instruction) > 500) AS long_instruction, count(*) FILTER (length(response) > 1000) AS long_response, count(*) FILTER ({latin("response")} OR {abbreviation("response")} OR {repeated("response")}) AS suspicious,
coalesce(avg(length(instruction)) FILTER (instruction <> ''), 0) AS avg_instruction_length, coalesce(avg(length(response)) FILTER (response <> ''), 0) AS avg_response_length, count(*) FILTER (is_duplicate) AS duplicates FROM d)
SELECT *, 0 AS bad_lines, 0 AS missing_instruction, 0 AS missing_response, empty_instruction + empty_response + duplicates AS critical, CASE WHEN empty_instruction + empty_response + duplicates = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM v"""

_EXTRACT = (r"^Translate [''\"](.+?)[''\"] to Tulu\.$", r"^What is the Tulu meaning of (.+?)\?$", r"^How do you say (.+?) in Tulu\?$", r"^Give the Tulu translation of (.+?)\.$", r"^Tulu word for (.+?)\.$")
_STRIPPED = strip("coalesce(instruction, '')")
_WORD = "nullif(" + strip("coalesce(" + ", ".join(f"nullif(regexp_extract({_STRIPPED}, '(?i){p}', 1), '')" for p in _EXTRACT) + ")") + ", '')"
_SPLIT = f"""WITH x AS (SELECT record_id AS pos, {fold(_WORD)} AS word FROM train),
g AS (SELECT word, row_number() OVER (ORDER BY md5('42|' || word), word) - 1 AS rank, count(*) OVER () AS n FROM (SELECT DISTINCT word FROM x WHERE word IS NOT NULL)),
c AS (SELECT pos, row_number() OVER (ORDER BY md5('42|' || pos), pos) - 1 AS rank, count(*) OVER () AS n FROM x WHERE word IS NULL),
r AS (SELECT x.pos, x.word, g.rank, g.n FROM x JOIN g USING (word) UNION ALL SELECT pos, NULL, rank, n FROM c),
a AS (SELECT pos, word, CASE WHEN rank < floor(n * 0.9::DOUBLE) THEN 'train' WHEN rank < floor(n * 0.9::DOUBLE) + floor(n * 0.05::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM r)
"""
SPLITS = _SPLIT + "SELECT pos, word, split FROM a"
SPLIT_STATS = _SPLIT + "SELECT split, count(*) AS records, round(100.0 * count(*) / sum(count(*)) OVER (), 2)::DOUBLE AS share, count(DISTINCT word) AS words FROM a GROUP BY split"
_ALL = "SELECT 'train' AS split, instruction, response FROM train UNION ALL SELECT 'validation', instruction, response FROM validation UNION ALL SELECT 'test', instruction, response FROM test"


def _leaks(key: str) -> str:
    return f"WITH u AS ({_ALL}), k AS (SELECT DISTINCT split, {key} AS key FROM u WHERE {key} IS NOT NULL) SELECT a.split || '|' || b.split AS pair, count(*) AS shared FROM k a JOIN k b ON a.key = b.key AND a.split < b.split GROUP BY 1"


PAIR_LEAKS = _leaks(f"({fold('coalesce(instruction, {})'.format(q('')))} || chr(1) || {fold('coalesce(response, {})'.format(q('')))})")
WORD_LEAKS = _leaks(fold(_WORD))

_I, _R = strip("instruction"), strip("response")
_PROMPT = "'<|im_start|>user\n' || i || '<|im_end|>\n<|im_start|>assistant\n'"
_FULL = _PROMPT + " || '<think>\n\n</think>\n\n' || regexp_replace(r, '\\A\\n+', '') || '<|im_end|>\n'"
_PAIR = f"WITH p AS (SELECT record_id AS pos, {_I} AS i, {_R} AS r FROM train WHERE {_I} <> '' AND {_R} <> '') "
CHAT = _PAIR + f"SELECT pos, {_PROMPT} AS prompt, {_FULL} AS full_text FROM p"
_IDS = _PAIR + f""", t AS (SELECT pos, list_transform(string_split({_FULL}, ''), lambda c: ord(c))[1:256] AS ids, least(length({_PROMPT}), 256) AS m FROM p)"""
MASKS = _IDS + "SELECT pos, ids AS input_ids, list_transform(ids, lambda x, k: CASE WHEN k <= m THEN -100 ELSE x END) AS labels, list_transform(ids, lambda x: 1) AS attention_mask FROM t"
PADDED = _IDS + """, b AS (SELECT *, CAST((row_number() OVER (ORDER BY pos) - 1) // 16 AS BIGINT) AS batch_no FROM t), n AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_no) AS longest FROM b)
SELECT pos, batch_no, list_concat(ids, list_transform(range(longest - len(ids)), lambda x: 0)) AS input_ids, list_concat(list_transform(ids, lambda x, k: CASE WHEN k <= m THEN -100 ELSE x END), list_transform(range(longest - len(ids)), lambda x: -100)) AS labels,
list_concat(list_transform(ids, lambda x: 1), list_transform(range(longest - len(ids)), lambda x: 0)) AS attention_mask FROM n"""
TOKENS = f"""WITH t AS (SELECT text FROM documents WHERE text IS NOT NULL), s AS (
SELECT 'characters' AS tokenizer, count(*) AS texts, sum(length(text)) AS characters, sum(length(text)) AS tokens FROM t
UNION ALL SELECT 'utf8_bytes', count(*), sum(length(text)), sum(strlen(text)) FROM t
UNION ALL SELECT 'words', count(*), sum(length(text)), sum(CASE WHEN {strip("text")} = '' THEN 0 ELSE len(regexp_split_to_array({strip("text")}, '{WS}+')) END) FROM t)
SELECT tokenizer, 'SUCCESS' AS status, texts, CAST(characters AS BIGINT) AS characters, CAST(tokens AS BIGINT) AS tokens, tokens / texts::DOUBLE AS average_tokens, characters / tokens::DOUBLE AS characters_per_token FROM s"""
BEST = f"SELECT * FROM ({TOKENS}) ORDER BY tokens, tokenizer LIMIT 1"
SCALARS = f"""SELECT record_id AS pos, {squeeze("response")} AS squeezed, {standardize("response")} AS standardized, {fix_format("response")} AS fix_formatted, {sub("response", r"\p{Nd}+")} AS no_digits, {sub("response", SPECIAL)} AS no_special,
{first_mark("response")} AS one_mark, {tight("response")} AS tight_marks, {fold("response")} AS folded, length(response) AS characters, replace(response, ' ', '') AS no_spaces,
{latin("response")} AS latin, regexp_matches(response, '\\p{{Nd}}') AS digit, regexp_matches(response, '{SPECIAL}') AS special, contains(response, ',,') AS double_comma, regexp_matches(response, '{WS}{{2,}}') AS double_space, {repeated("response")} AS repeated_mark, {abbreviation("response")} AS abbreviation,
{parts("response")} AS parts, {parts("response")}[1] AS first_part FROM train"""
TURNS = f"""WITH p AS (SELECT conv_id, {strip("tulu_text")} AS i, {strip("response_tulu")} AS r FROM raw_conversations WHERE tulu_text IS NOT NULL AND response_tulu IS NOT NULL)
SELECT conv_id, '<|im_start|>user\n' || i || '<|im_end|>\n<|im_start|>assistant\n<think>\n\n</think>\n\n' || r || '<|im_end|>\n' AS rendered FROM p"""
PREVIEW = "SELECT record_id AS pos, instruction, response FROM train ORDER BY record_id LIMIT 10"
PROJECTION = "SELECT batch_size, floor(n / batch_size) * 3 / (20 / 94.0::DOUBLE) / 3600 AS hours FROM (SELECT count(*) AS n FROM train), (VALUES (16), (32), (64)) b(batch_size)"
LITERALS = "SELECT * FROM (VALUES (0, 'Translate ''{}'' to Tulu.'), (1, 'What is the Tulu meaning of {}?'), (2, 'How do you say {} in Tulu?'), (3, 'Give the Tulu translation of {}.'), (4, 'Tulu word for {}.')) t(pos, template)"

# Packed fields, read as the marks' definitions say, without learning.
_EDGE = r"^[\s\p{Z}]+|[\s\p{Z}]+$"
_HELD = r"""\"(?:[^\"]|\"\")*\"|“[^”]*”|„[^“”]*”|«[^»]*»|「[^」]*」|''[^'']*''|\([^()]*\)|\p{Nd}+(?:[,，]\p{Nd}+)+"""
_MARK = r"[,;|/，、；｜／·•・‧¦،؛\t\n\r\x{2028}\x{2029}]"
_NUMBER = r"(?:^|\s)\(?\p{Nd}{1,3}[.)]\s"
PACKED = rf"""
WITH c AS (SELECT entry_id, regexp_replace(tulu, '{_EDGE}', '', 'g') AS s FROM clean_dictionary WHERE tulu IS NOT NULL),
b AS (SELECT entry_id, CASE WHEN starts_with(s, '[') AND ends_with(s, ']') THEN substr(s, 2, length(s) - 2) ELSE s END AS s FROM c WHERE lower(s) NOT IN ('', 'nan', 'na', 'n/a', 'null', 'none', 'nil', '-', '?')),
t AS (SELECT entry_id, CASE WHEN regexp_matches(s, '^\(?\p{{Nd}}{{1,3}}[.)]\s') THEN regexp_extract_all(s, '{_NUMBER}|{_HELD}|{_MARK}|(?s:.)') ELSE regexp_extract_all(s, '{_HELD}|{_MARK}|(?s:.)') END AS w FROM b),
u AS (SELECT entry_id, unnest(w) AS x, generate_subscripts(w, 1) AS k FROM t),
f AS (SELECT *, CAST(regexp_full_match(x, '{_MARK}') OR regexp_full_match(x, '{_NUMBER}') AS INT) AS cut FROM u),
g AS (SELECT *, sum(cut) OVER (PARTITION BY entry_id ORDER BY k) AS part FROM f),
p AS (SELECT entry_id, part, regexp_replace(string_agg(x, '' ORDER BY k), '{_EDGE}', '', 'g') AS v FROM g WHERE cut = 0 GROUP BY entry_id, part),
q AS (SELECT entry_id, part, regexp_replace(v, '^(?:[-*•·–—▪◦‣][\s\p{{Z}}]+)+', '') AS v FROM p),
r AS (SELECT entry_id, part, CASE WHEN regexp_full_match(v, '"(?:[^"]|"")*"') THEN replace(substr(v, 2, length(v) - 2), '""', '"') WHEN regexp_full_match(v, '“[^”]*”|''[^'']*''|«[^»]*»|„[^”]*”|「[^」]*」') THEN substr(v, 2, length(v) - 2) ELSE v END AS v FROM q),
z AS (SELECT entry_id, part, regexp_replace(v, '{_EDGE}', '', 'g') AS value FROM r),
n AS (SELECT entry_id, value, row_number() OVER (PARTITION BY entry_id ORDER BY part) AS pos, count(*) OVER (PARTITION BY entry_id) AS n FROM z WHERE NOT regexp_full_match(value, '[-*•·–—▪◦‣]?'))
SELECT entry_id, CAST(pos AS INT) AS pos, value FROM n WHERE n > 1
"""

# Files: what is written and read again is what was there.
_FILLED = f"{strip('instruction')} <> '' AND {strip('response')} <> ''"
LINES = "SELECT record_id, instruction, response FROM train"
LINE_NUMBERS = "SELECT 2 * count(*) AS lines, 2 * count(*) AS numbers, 1 AS first_line, 2 * count(*) AS last_line, count(*) AS filled FROM train"
CHECKED = f"SELECT {strip('instruction')} AS instruction, {strip('response')} AS response, count(*) AS records FROM train WHERE {_FILLED} GROUP BY ALL"
ROUTES = """SELECT 'Validate' AS status, count(*) + count(response) AS records, count(response) AS instructions, count(*) + count(response) AS responses FROM train WHERE instruction IS NOT NULL
UNION ALL SELECT 'Missing instruction', count(meta), 0, 0 FROM train
UNION ALL SELECT 'Missing response', count(*), count(*), 0 FROM train WHERE response IS NULL HAVING count(*) > 0
UNION ALL SELECT 'Record is not a JSON object', 2 * count(*), 0, 0 FROM train
UNION ALL SELECT 'Bad JSON', count(*), 0, 0 FROM train"""
SPLIT_LINES = " UNION ALL ".join(f"SELECT '{t}' AS split, instruction, response, count(*) AS records FROM {t} GROUP BY ALL" for t in ("train", "validation", "test"))
SHEETS = f"SELECT entry_id, CASE WHEN english NOT IN ({NA}) THEN english END AS english, CASE WHEN tulu NOT IN ({NA}) THEN tulu END AS tulu, page_no, page_no / 4.0 AS quarter, page_no > 9 AS late FROM clean_dictionary"
RATIOS = """SELECT * FROM (VALUES ('[0.9, 0.05, 0.05]', 'OK'), ('[0.8, 0.1, 0.2]', 'split ratios must sum to 1'), ('[1.0]', 'OK'), ('[0.7, 0.2, 0.1]', 'OK'), ('[]', 'split ratios must sum to 1')) AS t(ratios, verdict)"""
FAILING = f"""SELECT * FROM ({TOKENS}) WHERE tokenizer = 'characters'
UNION ALL SELECT name, 'FAILED', NULL, NULL, NULL, NULL, NULL FROM (VALUES ('missing'), ('raising')) AS f(name)"""
ROUTED = _filter(1) + "SELECT pos, reason FROM z"
ANSWERS = _PAIR + f"SELECT pos, list_transform(string_split({_FULL}, ''), lambda c: ord(c))[length({_PROMPT}) + 1 :] AS answer_ids FROM p"
ROUND_TRIPS = "SELECT tokenizer, (SELECT count(text) FROM documents) AS texts, (SELECT count(text) FROM documents) AS same FROM (VALUES ('byte_bpe_50k.json'), ('byte_bpe_50k.tiktoken'), ('byte_bpe_multi_50k.tiktoken')) AS t(tokenizer)"
MASK_CHECKS = f"SELECT count(*) AS examples, true AS labels_follow, true AS prompts_masked FROM train WHERE {_FILLED}"
_COUNTS = ("records", "kept", "modified", "dropped_empty", "duplicates_removed", "latin_left")
_TEXT = " || chr(10) || ".join(f"rpad('{c.replace('_', ' ').capitalize()}', {max(map(len, _COUNTS))}, ' ') || ' : ' || {c}" for c in _COUNTS)
_JSON = " || ',' || chr(10) || ".join(f"""'  "{c}": ' || {c}""" for c in _COUNTS)
REPORTS = f"WITH r AS ({IMPROVE_REPORT}) SELECT 'text' AS kind, 'Improvement' || chr(10) || '===========' || chr(10) || {_TEXT} || chr(10) AS report FROM r UNION ALL SELECT 'json', '{{' || chr(10) || {_JSON} || chr(10) || '}}' FROM r"
GUARDS = "SELECT what, 'missing' AS verdict FROM (VALUES ('table'), ('lines'), ('workbook'), ('vocabulary')) AS t(what)"
