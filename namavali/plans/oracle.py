"""The registered queries in SQL for DuckDB, written on their own: staged common table expressions over the same roll."""

from __future__ import annotations

from ..functions import constants as C
from ..functions.text import NOT_WS, WS
from .synth import duck_ctes


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ocr(x: str) -> str:
    for a, b in C.OCR_CORRECTIONS:
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def key(x: str) -> str:
    return f"translate(coalesce({x}, ''), {q(C.KEY_FROM)}, {q(C.KEY_TO)})"


def label_only(x: str) -> str:
    t = strip(x)
    return f"(regexp_matches({t}, '^({C.LABEL_WORDS}){WS}*[:：]?{WS}*$') OR regexp_matches({t}, '^({C.HEADING_WORDS})'))"


def clean(x: str) -> str:
    x = f"regexp_replace({x}, '^नावः{WS}*', '')"
    x = f"regexp_replace({x}, '^नाव['',]?{WS}*', '')"
    for e in C.LABEL_ENDINGS:
        x = f"regexp_replace({x}, '{WS}+{e}$', '')"
    x = f"string_split({x}, ' उर्फ ')[1]"
    x = f"regexp_replace({x}, '^उर्फ{WS}+', '')"
    x = f"regexp_replace({x}, '{NOT_WS}+च्या{WS}+', '', 'g')"
    return collapse(f"regexp_replace({x}, '[ः'',]', '', 'g')")


def corrupt(x: str) -> str:
    tests = ("^[a-zA-Z]{1,3}:", f"[a-zA-Z]{{4,}}{WS}+[a-zA-Z]{{4,}}", C.ARTIFACTS, rf"^\p{{Nd}}+{WS}+(Fert|fem|feat|लिंग){WS}*:", rf"^\p{{Nd}}{{2,3}}{WS}+(Fart|Fert)")
    return "(" + " OR ".join(f"regexp_matches({x}, '{t}')" for t in tests) + ")"


def reason(n: str) -> str:
    """n: a cleaned name."""
    return f"""CASE WHEN length({n}) < 3 THEN 'Too short after cleaning (less than 3 characters)' WHEN {label_only(n)} THEN 'Label only (not a name)'
  WHEN regexp_matches({n}, '[a-zA-Z]') THEN 'Contains English characters' WHEN regexp_matches({n}, '\\p{{Nd}}') THEN 'Contains numbers'
  WHEN NOT regexp_matches({n}, '^(?:[\\x{{900}}-\\x{{97f}}-]|{WS})+$') THEN 'Contains invalid special characters'
  WHEN length(regexp_replace({n}, '[^\\x{{900}}-\\x{{97f}}]', '', 'g')) < 3 THEN 'Insufficient Devanagari characters'
  WHEN length(regexp_replace({n}, '[^-;:|]', '', 'g')) > 0.3 * length(replace({n}, ' ', '')) THEN 'Excessive punctuation' END"""


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


def latin(x: str) -> str:
    mark = "chr(57344)"
    cons, signs = "".join(k for k, _ in C.ITRANS_CONSONANTS), "".join(k for k, _ in C.ITRANS_OTHERS if "ा" <= k <= "्")
    x = f"regexp_replace({x}, '([{cons}])', '\\1' || {mark}, 'g')"
    x = f"regexp_replace({x}, {mark} || '([{signs}])', '\\1', 'g')"
    x = f"replace({x}, {mark}, 'a')"
    for a, b in (*C.ITRANS_CONSONANTS, *C.ITRANS_OTHERS):
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x


def plain(x: str) -> str:
    return f"regexp_replace({x}, '[^\\x00-\\x7f]', '^', 'g')"


def ascii_latin(x: str) -> str:
    """The spelling with one ASCII character for each that has none: DuckDB counts bytes in edit distances."""
    return plain(f"lower({latin(x)})")


_ENDS = lambda x, e: f"ends_with({x}, {q(e)})"


def pattern_ctes(src: str, out: str) -> str:
    """From src(id, name): out(id, name, flags, suggested), step by step."""
    values = ", ".join(f"({q(a)}, {q(b)})" for a, b in C.NAME_CORRECTIONS)
    cut = lambda x, n=1: f"left({x}, greatest(length({x}) - {n}, 0))"
    final = "length(name) > 2 AND (" + " OR ".join(_ENDS("name", e) for e in ("राच", "शीच", "ाच", "ीच")) + ")"
    return f"""{out}_k(wrong, known) AS (VALUES {values}),
{out}_1 AS (SELECT id, name, CASE WHEN contains(name, 'ण्या') THEN 'ण्या→प्पा' WHEN contains(name, 'ण्पा') THEN 'ण्पा→प्पा'
    WHEN contains(name, 'णप्पा') AND NOT starts_with(name, 'ण') THEN 'णप्पा→प्पा' END AS f1 FROM {src}),
{out}_2 AS (SELECT *, CASE f1 WHEN 'ण्या→प्पा' THEN replace(name, 'ण्या', 'प्पा') WHEN 'ण्पा→प्पा' THEN replace(name, 'ण्पा', 'प्पा')
    WHEN 'णप्पा→प्पा' THEN replace(name, 'णप्पा', 'प्पा') ELSE name END AS s FROM {out}_1),
{out}_3 AS (SELECT * REPLACE (CASE WHEN contains(name, 'ाण्') THEN replace(replace(s, 'ाण्या', 'ाप्पा'), 'ाण्पा', 'ाप्पा') ELSE s END AS s),
    CASE WHEN contains(name, 'ाण्') THEN 'ाण्→ाप्' END AS f2, CASE WHEN {final} THEN 'च→व' END AS f3, CASE WHEN {_ENDS("name", "ं")} THEN 'trailing_ं' END AS f4 FROM {out}_2),
{out}_4 AS (SELECT * REPLACE (CASE WHEN f3 IS NOT NULL THEN {cut("s")} || 'व' ELSE s END AS s) FROM {out}_3),
{out}_5 AS (SELECT * REPLACE (CASE WHEN f4 IS NOT NULL THEN {cut("s")} ELSE s END AS s) FROM {out}_4),
{out}_6 AS (SELECT x.* REPLACE (coalesce(k.known, s) AS s), CASE WHEN k.known IS NOT NULL THEN 'phonetic_dict' END AS f5,
    CASE WHEN {_ENDS("name", "त्त")} THEN 'त्त→त' WHEN {_ENDS("name", "राध")} THEN 'राध→राम' WHEN {_ENDS("name", "नाध")} THEN 'नाध→नाथ' END AS f6
    FROM {out}_5 x LEFT JOIN {out}_k k ON x.name = k.wrong),
{out} AS (SELECT id, name, list_filter([f1, f2, f3, f4, f5, f6], lambda f: f IS NOT NULL) AS flags,
    CASE f6 WHEN 'त्त→त' THEN {cut("s", 2)} || 'त' WHEN 'राध→राम' THEN {cut("s")} || 'म' WHEN 'नाध→नाथ' THEN {cut("s")} || 'थ' ELSE s END AS suggested FROM {out}_6)"""


def corrected(mode: str) -> str:
    take = {"phonetic_dict": "list_contains(flags, 'phonetic_dict')", "pattern": "len(list_filter(flags, lambda f: f <> 'phonetic_dict')) > 0", "both": "len(flags) > 0"}[mode]
    return f"CASE WHEN {take} THEN suggested ELSE name END"


def morphology(x: str) -> str:
    n = strip(x)
    bare = strip(f"translate({n}, {q(C.DEPENDENT_SIGNS)}, '')")
    halants = f"(length({n}) - length(replace({n}, '्', '')))"
    return f"""CASE WHEN length({n}) = 0 THEN ['Empty name'] ELSE list_filter([
  CASE WHEN contains({q(C.DEPENDENT_SIGNS)}, left({n}, 1)) THEN 'Starts with dependent vowel mark: ''' || left({n}, 1) || '''' END,
  CASE WHEN length({n}) <= 2 THEN 'Very short (' || length({n}) || ' chars), likely fragment' END,
  CASE WHEN {_ENDS(n, "्")} THEN 'Ends with halant (्), incomplete word' END,
  CASE WHEN length({n}) <= 4 AND {halants} > 0 AND {halants} * 2 >= length({n}) THEN 'Appears to be orphaned consonant cluster' END,
  CASE WHEN starts_with({n}, '़') OR contains({n}, ' ़') THEN 'Nukta (़) in invalid position' END,
  CASE WHEN contains({n}, '  ') OR regexp_matches({n}, '[॰।॥]') THEN 'Contains unusual spacing or punctuation' END,
  CASE WHEN {bare} = '' THEN 'Contains only vowel marks, no base characters' END], lambda r: r IS NOT NULL) END"""


def extraction_ctes(src: str, p: str) -> str:
    """From blocks src(pdf_file, page_num, block_no, block_text): {p}_names with name, reason and cleaned."""
    skip = " OR ".join(f"contains(line, {q(s)})" for s in C.SKIP_PHRASES)
    labels = ", ".join(f"({i}, {q(x)})" for i, x in enumerate(C.LABELS))
    ids = "pdf_file, page_num, block_no, line_no, part_no"
    name = "regexp_replace(name, '^" + WS + "*(?:नाव|नाब|पतीचे|वडिलांचे|पत्नीचे|आईचे)" + WS + "*[:;]" + WS + "*', '')"
    return rf"""{p}_lines AS (SELECT pdf_file, page_num, block_no, i AS line_no, {strip("l[i + 1]")} AS line
  FROM (SELECT *, string_split(block_text, chr(10)) AS l FROM {src}) x, unnest(range(len(l))) AS u(i)),
{p}_named AS (SELECT * FROM {p}_lines WHERE (contains(line, 'नाव') OR contains(line, 'नाब')) AND (contains(line, ':') OR contains(line, ';'))
  AND NOT ({skip}) AND NOT (regexp_matches(line, '^(?:[\p{{Nd}}A-Z-]|{WS})+$') AND length(line) < 20)),
{p}_split AS (SELECT *, list_filter(string_split(regexp_replace(line, '((?:पतीचे{WS}*)?(?:वडिलांचे{WS}*)?(?:पत्नीचे{WS}*)?(?:आईचे{WS}*)?)((?:नाव|नाब){WS}*[:;])',
    chr(57345) || '\1' || chr(57345) || '\2', 'g'), chr(57345)), lambda x: contains(x, 'नाव') OR contains(x, 'नाब')) AS parts FROM {p}_named),
{p}_parts AS (SELECT pdf_file, page_num, block_no, line_no, j AS part_no, parts[j + 1] AS part, {ocr("parts[j + 1]")} AS fixed FROM {p}_split, unnest(range(len(parts))) AS u(j)),
{p}_tried AS (SELECT {ids}, ord, CASE WHEN regexp_matches(fixed, label || '{WS}*[:：]{WS}*([^\n]+)') THEN regexp_extract(fixed, label || '{WS}*[:：]{WS}*([^\n]+)', 1)
    WHEN regexp_matches(fixed, label || '{WS}+([^\n]+)') THEN regexp_extract(fixed, label || '{WS}+([^\n]+)', 1) ELSE '' END AS raw
  FROM {p}_parts, (VALUES {labels}) AS v(ord, label) WHERE contains(part, label)),
{p}_cut AS (SELECT {ids}, ord, regexp_replace(regexp_replace({collapse("raw")}, '^(?:[-:：]|{WS})+', ''), '(?s)[;|].*$', '') AS name FROM {p}_tried),
{p}_first AS (SELECT {ids}, arg_min({strip("name")}, ord) AS name FROM {p}_cut WHERE NOT {label_only("name")} AND NOT {corrupt("name")} AND {strip("name")} <> '' GROUP BY {ids}),
{p}_tidy AS (SELECT {ids}, {strip(f"regexp_replace({collapse(f"regexp_replace({collapse(name)}, '{WS}*(?:att|Fart|Fert){WS}*', ' ', 'g')")}, '^(?:[:;]|{WS})+', '')")} AS name FROM {p}_first),
{p}_clean AS (SELECT *, {clean("name")} AS cleaned FROM {p}_tidy WHERE name <> ''),
{p}_names AS (SELECT *, {reason("cleaned")} AS reason FROM {p}_clean)"""


SEGMENT = rf"""fixed AS (SELECT pdf_file, page_num, {ocr("text")} AS text FROM roll WHERE text IS NOT NULL),
lines AS (SELECT pdf_file, page_num, i::INT AS line_no, l[i + 1] AS line FROM (SELECT *, string_split(text, chr(10)) AS l FROM fixed) x, unnest(range(len(l))) AS u(i)),
seg AS (SELECT *, (1 + sum(CASE WHEN line_no > 0 AND regexp_matches({strip("line")}, '^\p{{Nd}}+$') THEN 1 ELSE 0 END) OVER (PARTITION BY pdf_file, page_num ORDER BY line_no))::INT AS block_no FROM lines),
blocks AS (SELECT pdf_file, page_num, block_no, string_agg(line, chr(10) ORDER BY line_no) AS block_text FROM seg GROUP BY pdf_file, page_num, block_no),
labelled AS (SELECT * FROM blocks WHERE contains(block_text, 'नाव'))"""

EXTRACT = f"""{extraction_ctes("labelled", "a")},
good_a AS (SELECT * FROM a_names WHERE reason IS NULL AND cleaned <> ''),
empty_blocks AS (SELECT l.*, {ocr("block_text")} AS repaired FROM labelled l ANTI JOIN good_a g USING (pdf_file, page_num, block_no)),
second AS (SELECT pdf_file, page_num, block_no, repaired AS block_text FROM empty_blocks WHERE repaired <> block_text),
{extraction_ctes("second", "b")},
both_names AS (SELECT * FROM a_names UNION ALL SELECT * FROM b_names),
accepted AS (SELECT pdf_file, page_num, block_no, line_no::INT AS line_no, part_no::INT AS part_no, cleaned AS full_name FROM both_names WHERE reason IS NULL AND cleaned <> ''),
rejected AS (SELECT pdf_file, page_num, block_no, name, reason FROM both_names WHERE reason IS NOT NULL AND length(name) >= 3),
failed AS (SELECT pdf_file, page_num, block_no, left(block_text, 200) AS raw_text, 'Could not extract any names from text block' AS reason FROM empty_blocks WHERE repaired = block_text),
firsts AS (SELECT pdf_file, page_num, block_no, line_no, part_no, i::INT AS word_no, w[i + 1] AS name
  FROM (SELECT *, {words("full_name")} AS w FROM accepted) x, unnest(range(CASE WHEN len(w) = 3 THEN 2 ELSE least(len(w), 1) END)) AS u(i)),
ordered AS (SELECT *, row_number() OVER (ORDER BY pdf_file, page_num, block_no, line_no, part_no, word_no) AS seq, {key("name")} AS norm FROM firsts),
kept AS (SELECT pdf_file, seq AS place, name, norm FROM ordered QUALIFY row_number() OVER (PARTITION BY norm ORDER BY seq) = 1),
listed AS (SELECT row_number() OVER (ORDER BY place) AS seq, name, norm FROM kept)"""

_WITH = f"WITH RECURSIVE {duck_ctes()},\n{SEGMENT},\n{EXTRACT}"
_ROLL = f"WITH {duck_ctes()}"
_SEG = f"WITH {duck_ctes()},\n{SEGMENT}"


def _given(extra: str = "") -> str:
    """Distinct given names with their least id."""
    return f"WITH {duck_ctes()}, given AS (SELECT min(id) AS id, given AS name FROM people GROUP BY given){extra}"


def _window(src: str, by: str, size: int) -> str:
    """Rows of src(grp, rn, norm, name) accepted by a window of `size` keys."""
    return f"""w AS (
  SELECT grp, rn, name, norm, [norm] AS recent, true AS ok FROM {src} WHERE rn = 1
  UNION ALL
  SELECT s.grp, s.rn, s.name, s.norm, CASE WHEN list_contains(w.recent, s.norm) THEN w.recent ELSE list_append(CASE WHEN len(w.recent) >= {size} THEN w.recent[2:] ELSE w.recent END, s.norm) END,
    NOT list_contains(w.recent, s.norm)
  FROM w JOIN {src} s ON s.grp = w.grp AND s.rn = w.rn + 1)"""


def cluster_ctes(src: str) -> str:
    """From src(seq, name): members(cluster_id, pos, name, latin, cnt). A name joins the first cluster of its length that
    it differs from in one character throughout, which is what taking the free ones seed by seed comes to."""
    close = f"list_transform(g.cl, lambda c: len(list_filter(c, lambda m: levenshtein({plain('m')}, {plain('s.latin')}) <> 1)) = 0)"
    return f"""counted AS (SELECT name, count(*) AS cnt, min(seq) AS first_seq FROM {src} GROUP BY name),
spelled AS (SELECT *, lower({latin("name")}) AS latin FROM counted),
placed AS (SELECT *, length(latin) AS grp, row_number() OVER (PARTITION BY length(latin) ORDER BY first_seq) AS rn FROM spelled),
g AS (
  SELECT grp, rn, name, [[latin]] AS cl, 1::BIGINT AS k FROM placed WHERE rn = 1
  UNION ALL
  SELECT grp, rn, name, CASE WHEN hit IS NULL THEN list_append(cl, [latin]) ELSE list_transform(cl, lambda c, i: CASE WHEN i = hit THEN list_append(c, latin) ELSE c END) END,
    coalesce(hit, len(cl) + 1)::BIGINT
  FROM (SELECT s.grp, s.rn, s.name, s.latin, g.cl, CASE WHEN list_contains({close}, true) THEN list_position({close}, true) END AS hit FROM g JOIN placed s ON s.grp = g.grp AND s.rn = g.rn + 1) x),
sized AS (SELECT p.*, g.k, count(*) OVER (PARTITION BY p.grp, g.k) AS n, min(p.first_seq) OVER (PARTITION BY p.grp, g.k) AS seed,
  min(p.first_seq) OVER (PARTITION BY p.grp) AS len_first FROM placed p JOIN g USING (grp, rn)),
members AS (SELECT dense_rank() OVER (ORDER BY len_first, seed)::INT AS cluster_id, row_number() OVER (PARTITION BY grp, k ORDER BY cnt DESC, first_seq)::INT AS pos, name, latin, cnt FROM sized WHERE n > 1)"""


def validation_ctes(mode: str | None) -> str:
    """From listed(seq, name): now, members, ill, patterns, invalid, valid."""
    change = corrected(mode) if mode else "name"
    return f"""{pattern_ctes("(SELECT seq AS id, name FROM listed)", "p")},
now AS (SELECT id AS seq, name AS was, {change} AS name FROM p),
{cluster_ctes("now")},
ill AS (SELECT seq, name, {morphology("name")} AS reasons FROM now WHERE len({morphology("name")}) > 0),
patterns AS (SELECT id AS seq, name, flags, suggested FROM p WHERE len(flags) > 0),
invalid AS (SELECT name FROM members UNION SELECT name FROM ill UNION SELECT name FROM patterns),
valid AS (SELECT seq, name FROM now ANTI JOIN invalid USING (name))"""


WINDOW = 20
_DUPS = f"groups AS (SELECT norm, norm AS normalized, count(*) AS cnt, min(seq) AS first_seq FROM ordered GROUP BY norm)"
_SOURCES = "sources AS (SELECT norm AS normalized, string_agg(DISTINCT pdf_file, ',' ORDER BY pdf_file) AS pdfs, count(DISTINCT pdf_file)::INT AS n_pdfs FROM ordered GROUP BY norm)"
_PASSED = f"{_WITH}, src AS (SELECT 1 AS grp, seq AS rn, name, norm FROM ordered), {_window('src', 'grp', WINDOW)}, passed AS (SELECT row_number() OVER (ORDER BY rn) AS seq, name, norm FROM w WHERE ok)"
_LATIN = f"latin_names AS (SELECT id AS first_seq, name, lower({latin('name')}) AS latin, {ascii_latin('name')} AS plain FROM given)"

SQL: dict[str, str] = {
    "line_explode": f"SELECT doc_id, i::INT AS line_no, l[i + 1] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL) x, unnest(range(len(l))) AS u(i)",
    "block_segmentation": f"{_SEG} SELECT pdf_file, page_num, line_no, block_no, line FROM seg",
    "block_filter": f"{_SEG} SELECT pdf_file, page_num, block_no, block_text FROM labelled",
    "page_range_filter": f"{_ROLL} SELECT pdf_file, page_num, length(text) AS n_chars FROM roll WHERE page_num BETWEEN 4 AND 6",
    "ocr_fallback_flag": f"{_ROLL} SELECT pdf_file, page_num, coalesce(length({strip('text')}) < 100, true) AS needs_ocr FROM roll",
    "skip_line_filter": f"{_SEG} SELECT pdf_file, page_num, line_no, line FROM lines WHERE NOT (" + " OR ".join(f"contains(line, {q(s)})" for s in C.SKIP_PHRASES) + ")",
    "id_line_filter": rf"{_SEG} SELECT pdf_file, page_num, line_no, line FROM lines WHERE regexp_matches({strip('line')}, '^(?:[\p{{Nd}}A-Z-]|{WS})+$') AND length({strip('line')}) < 20",
    "name_lines": f"{_WITH} SELECT pdf_file, page_num, block_no, line_no::INT AS line_no, line FROM a_named",
    "label_split": f"{_WITH} SELECT pdf_file, page_num, block_no, line_no::INT AS line_no, part_no::INT AS part_no, part FROM a_parts",
    "extract_name": f"{_WITH} SELECT pdf_file, page_num, block_no, line_no::INT AS line_no, part_no::INT AS part_no, name FROM a_tidy WHERE name <> ''",
    "accepted_names": f"{_WITH} SELECT * FROM accepted",
    "rejected_names": f"{_WITH} SELECT * FROM rejected",
    "reject_reasons": f"{_WITH} SELECT reason, count(*) AS n FROM rejected GROUP BY reason",
    "block_errors": f"{_WITH} SELECT * FROM failed",
    "page_errors": f"{_ROLL} SELECT pdf_file, page_num, 'No text could be read from the page' AS reason FROM roll WHERE coalesce({strip('text')} = '', true)",
    "first_names": f"{_WITH} SELECT * FROM firsts",
    "name_messages": f"{_WITH} SELECT pdf_file, page_num, block_no, line_no, part_no, -1 AS word_no, 'full' AS type, full_name AS name FROM accepted UNION ALL SELECT pdf_file, page_num, block_no, line_no, part_no, word_no, 'first', name FROM firsts",
    "word_count": f"{_ROLL} SELECT id, len({words('full_name')})::INT AS n_words FROM people",
    "file_stem": "SELECT page_id, regexp_replace(regexp_extract('/rolls/' || page_id || '.part.pdf', '([^/]+)$', 1), '\\.[^.]+$', '') AS stem FROM pages",
    "names_file_scan": f"{_ROLL} SELECT pdf_file, (2 * row_number() OVER (PARTITION BY pdf_file ORDER BY id) - 1)::INT AS line_no, {strip('full_name')} AS name FROM people",
    "ocr_corrections": f"{_ROLL} SELECT id, {ocr('card')} AS card FROM cards",
    "normalize_key": f"{_ROLL} SELECT id, {key('full_name')} AS norm FROM people",
    "is_label_only": f"{_ROLL} SELECT id, {label_only('full_name')} AS label_only, {label_only('card')} AS card_label FROM cards JOIN people USING (id)",
    "clean_name": f"{_ROLL} SELECT id, {clean('full_name')} AS cleaned, {clean(chr(39) + 'नाव, ' + chr(39) + ' || full_name || ' + chr(39) + ' वडिलांचे' + chr(39))} AS labelled FROM people",
    "transliterate": f"{_ROLL} SELECT id, {latin('full_name')} AS spelling FROM people",
    "edit_distance": f"{_given(', ' + _LATIN)} SELECT a.name AS a, b.name AS b, levenshtein(a.plain, b.plain) AS distance FROM latin_names a JOIN latin_names b ON length(a.latin) = length(b.latin) AND a.name < b.name",
    "phonetic_similarity": f"{_ROLL} SELECT id, CASE WHEN greatest(length(a), length(b)) = 0 THEN 1.0::DOUBLE ELSE round(1 - levenshtein(a, b)::DOUBLE / greatest(length(a), length(b)), 6) END AS similarity FROM (SELECT id, {ascii_latin('given')} AS a, {ascii_latin('middle')} AS b FROM people) x",
    "ocr_patterns": f"{_given(', ' + pattern_ctes('given', 'p'))} SELECT name, array_to_string(flags, '|') AS flags, suggested FROM p",
    "pattern_report": f"{_given(', ' + pattern_ctes('given', 'p'))} SELECT name AS original, suggested, array_to_string(flags, ', ') AS patterns FROM p WHERE len(flags) > 0",
    "ocr_corruption": f"{_ROLL} SELECT id, {corrupt('full_name')} AS corrupt, {corrupt('card')} AS card_corrupt FROM cards JOIN people USING (id)",
    "name_validation": f"{_ROLL} SELECT id, {reason('c')} AS reason FROM (SELECT id, {clean('full_name')} AS c FROM people) x",
    "morphology": f"{_given()} SELECT name, array_to_string({morphology('name')}, '|') AS reasons, len({morphology('name')}) = 0 AS is_valid FROM given",
    **{f"corrected_names_{m}": f"{_given(', ' + pattern_ctes('given', 'p'))} SELECT name, {corrected(m)} AS corrected FROM p" for m in ("both", "pattern", "phonetic_dict")},
    "phonetic_dict_lookup": f"{_ROLL} SELECT id, given, known FROM people LEFT JOIN (VALUES {', '.join(f'({q(a)}, {q(b)})' for a, b in C.NAME_CORRECTIONS)}) AS k(wrong, known) ON given = wrong",
    "name_counts": f"{_WITH} SELECT name, count(*) AS cnt, min(seq) AS first_seq FROM ordered GROUP BY name",
    "name_line_numbers": f"{_WITH} SELECT pdf_file, full_name, row_number() OVER (PARTITION BY pdf_file ORDER BY page_num, block_no, line_no, part_no)::INT AS name_no FROM accepted",
    "dedup_exact_full": f"{_WITH} SELECT pdf_file, page_num, block_no, line_no, part_no, full_name AS name FROM accepted QUALIFY row_number() OVER (PARTITION BY pdf_file, {key('full_name')} ORDER BY page_num, block_no, line_no, part_no) = 1",
    "dedup_exact_first": f"{_WITH} SELECT place AS seq, name, norm FROM kept",
    "dedup_window_full": f"{_WITH}, src AS (SELECT pdf_file AS grp, row_number() OVER (PARTITION BY pdf_file ORDER BY page_num, block_no, line_no, part_no) AS rn, full_name AS name, {key('full_name')} AS norm FROM accepted), {_window('src', 'grp', WINDOW)} SELECT grp AS pdf_file, rn::INT AS name_no, name FROM w WHERE ok",
    "dedup_window_first": f"{_WITH}, src AS (SELECT 1 AS grp, seq AS rn, name, norm FROM ordered), {_window('src', 'grp', WINDOW)} SELECT rn AS seq, name FROM w WHERE ok",
    "duplicate_groups_raw": f"{_WITH}, {_DUPS} SELECT normalized, cnt, first_seq, seq, name FROM groups JOIN ordered USING (norm)",
    "duplicate_groups": f"{_WITH}, {_DUPS} SELECT normalized, cnt, first_seq, seq, name FROM groups JOIN ordered USING (norm) WHERE cnt > 1",
    "duplicate_groups_windowed": f"{_PASSED} SELECT norm AS normalized, count(*) AS cnt, min(seq) AS first_seq FROM passed GROUP BY norm HAVING count(*) > 1",
    "duplicate_stats_windowed": f"{_PASSED}, g AS (SELECT norm, count(*) AS c FROM passed GROUP BY norm) SELECT sum(c)::BIGINT AS total, count(*) AS unique_names, count(*) FILTER (c > 1) AS duplicate_groups, sum(c - 1)::BIGINT AS total_duplicates, round(sum(c - 1) * 100.0::DOUBLE / sum(c), 2) AS duplicate_rate FROM g",
    "duplicate_stats": f"{_WITH}, g AS (SELECT norm, count(*) AS c FROM ordered GROUP BY norm) SELECT sum(c)::BIGINT AS total, count(*) AS unique_names, count(*) FILTER (c > 1) AS duplicate_groups, sum(c - 1)::BIGINT AS total_duplicates, round(sum(c - 1) * 100.0::DOUBLE / sum(c), 2) AS duplicate_rate FROM g",
    "top_duplicate_groups": f"{_WITH}, {_DUPS} SELECT normalized, cnt, first_seq FROM groups WHERE cnt > 1 ORDER BY cnt DESC, first_seq LIMIT 15",
    "name_sources": f"{_WITH}, {_SOURCES} SELECT * FROM sources",
    "cross_file_names": f"{_WITH}, {_SOURCES} SELECT * FROM sources WHERE n_pdfs > 1",
    "top_cross_file": f"{_WITH}, {_SOURCES} SELECT normalized, n_pdfs FROM sources WHERE n_pdfs > 1 ORDER BY n_pdfs DESC, normalized LIMIT 5",
    "per_pdf_counts": f"{_WITH} SELECT pdf_file, count(*) AS written FROM (SELECT DISTINCT pdf_file, {key('full_name')} FROM accepted) x GROUP BY pdf_file",
    "per_page_counts": f"{_WITH} SELECT r.pdf_file, r.page_num, count(a.full_name) AS n_names FROM roll r LEFT JOIN accepted a USING (pdf_file, page_num) GROUP BY r.pdf_file, r.page_num",
    "file_status": f"""{_WITH}, f AS (SELECT pdf_file, max(page_num) - 2 AS n, starts_with(pdf_file, 'roll_I') AS bad FROM roll GROUP BY pdf_file), a AS (SELECT pdf_file, count(*) AS n FROM accepted GROUP BY pdf_file)
SELECT f.pdf_file, CASE WHEN bad THEN 'failed' ELSE 'completed' END AS status, CASE WHEN bad THEN 0 ELSE coalesce(a.n, 0) END AS names_count,
  CASE WHEN bad THEN 0 ELSE f.n END::INT AS n_pages, CASE WHEN bad THEN 'UnicodeDecodeError' END AS reason FROM f LEFT JOIN a USING (pdf_file)""",
    "correction_stats": f"{_WITH}, {pattern_ctes('(SELECT seq AS id, name FROM listed)', 'p')} SELECT count(*) AS total, count(*) FILTER ({corrected('both')} <> name) AS by_both, count(*) FILTER ({corrected('pattern')} <> name) AS by_pattern, count(*) FILTER ({corrected('phonetic_dict')} <> name) AS by_dict FROM p",
    "latin_length_groups": f"{_given(', ' + _LATIN)} SELECT length(latin)::INT AS latin_len, count(*) AS n, min(first_seq) AS first_seq FROM latin_names GROUP BY 1",
    "phonetic_pairs": f"{_given(', ' + _LATIN)} SELECT a.name AS name_a, b.name AS name_b, a.latin AS latin_a, b.latin AS latin_b FROM latin_names a JOIN latin_names b ON length(a.latin) = length(b.latin) AND a.first_seq < b.first_seq AND a.latin <> b.latin AND levenshtein(a.plain, b.plain) = 1",
    "card_boxes": """WITH r AS (SELECT page_id % 7 AS page_id, (page_id * 37) % 400::DOUBLE AS x0, (page_id * 53) % 700::DOUBLE AS y0, 100 + (page_id * 29) % 400::DOUBLE AS w, 40 + (page_id * 31) % 350::DOUBLE AS h FROM pages),
boxes AS (SELECT page_id, x0, y0, x0 + w AS x1, y0 + h AS y1 FROM r WHERE page_id < 4 AND w > 150 AND w < 400 AND h > 80 AND h < 300),
f AS (SELECT page_id, y0, lead(y0) OVER (PARTITION BY page_id ORDER BY y0) AS y1 FROM (SELECT DISTINCT page_id, y0 FROM r) x),
v AS (SELECT page_id, x0, lead(x0) OVER (PARTITION BY page_id ORDER BY x0) AS x1 FROM (SELECT DISTINCT page_id, x0 * 3 AS x0 FROM r) x),
cells AS (SELECT f.page_id, v.x0, f.y0, v.x1, f.y1 FROM f JOIN v USING (page_id) WHERE v.x1 - v.x0 > 150 AND f.y1 - f.y0 > 80)
SELECT page_id, x0::DOUBLE AS x0, y0::DOUBLE AS y0, x1::DOUBLE AS x1, y1::DOUBLE AS y1 FROM boxes UNION ALL
SELECT page_id, x0::DOUBLE, y0::DOUBLE, x1::DOUBLE, y1::DOUBLE FROM cells WHERE page_id NOT IN (SELECT page_id FROM boxes)""",
    "report_rejects": f"""{_WITH}, e AS (SELECT *, row_number() OVER (ORDER BY pdf_file, page_num, block_no) AS item FROM failed),
r AS (SELECT *, row_number() OVER (ORDER BY pdf_file, page_num, block_no, name, reason) AS item FROM rejected),
x AS (SELECT 1 AS section, item, ['--- Error #' || item || ' ---', 'File: ' || pdf_file, 'Page: ' || page_num, 'Reason: ' || reason, 'Raw Text:', raw_text] AS l FROM e
  UNION ALL SELECT 2, item, ['--- Rejected #' || item || ' ---', 'File: ' || pdf_file, 'Page: ' || page_num, 'Name: ' || name, 'Reason: ' || reason] FROM r)
SELECT section, item, i::INT AS line_no, l[i + 1] AS line FROM x, unnest(range(len(l))) AS u(i)""",
    "report_errors": f"""{_WITH}, b AS (SELECT pdf_file, page_num, block_no, raw_text, reason FROM failed
  UNION ALL SELECT pdf_file, page_num, 0, '', 'No text could be read from the page' FROM roll WHERE coalesce({strip('text')} = '', true)),
e AS (SELECT *, row_number() OVER (ORDER BY pdf_file, page_num, block_no) AS item FROM b),
r AS (SELECT *, row_number() OVER (ORDER BY pdf_file, page_num, block_no, name, reason) AS item FROM rejected),
x AS (SELECT 1 AS section, item, ['--- Error #' || item || ' ---', 'File: ' || pdf_file, 'Page: ' || page_num, 'Reason: ' || reason, 'Raw Text:', raw_text] AS l FROM e
  UNION ALL SELECT 2, item, ['--- Rejected #' || item || ' ---', 'File: ' || pdf_file, 'Page: ' || page_num, 'Name: ' || name, 'Reason: ' || reason] FROM r)
SELECT section, item, i::INT AS line_no, l[i + 1] AS line FROM x, unnest(range(len(l))) AS u(i)""",
    "report_summary": f"""{_WITH}, {_SOURCES}, n AS (SELECT pdf_file, count(DISTINCT {key('full_name')}) AS n FROM accepted GROUP BY pdf_file),
t AS (SELECT *, row_number() OVER (ORDER BY n_pdfs DESC, normalized) AS item FROM sources WHERE n_pdfs > 1),
x AS (SELECT 1 AS section, row_number() OVER (ORDER BY pdf_file) AS item, [pdf_file || ':', '  Full names: ' || n] AS l FROM n
  UNION ALL SELECT 2, 0, ['Global First Names', '  Total unique first names collected: ' || (SELECT count(*) FROM listed), '  Names appearing in multiple PDFs: ' || (SELECT count(*) FROM t)]
  UNION ALL SELECT 3, item, ['    ' || normalized || ': ' || n_pdfs || ' PDFs'] FROM t WHERE item <= 5
  UNION ALL SELECT 4, 0, ['Total full names written: ' || sum(n)] FROM n)
SELECT section, item, i::INT AS line_no, l[i + 1] AS line FROM x, unnest(range(len(l))) AS u(i)""",
    "report_cross_file": f"""{_WITH}, {_SOURCES}, c AS (SELECT *, row_number() OVER (ORDER BY n_pdfs DESC, normalized) AS item FROM sources WHERE n_pdfs > 1),
x AS (SELECT 2 AS section, item, list_concat([normalized, '  Found in ' || n_pdfs || ' PDF(s):'], list_transform(string_split(pdfs, ','), lambda p: '    - ' || p)) AS l FROM c
  UNION ALL SELECT 1, 0, ['CROSS-FILE FIRST NAMES REPORT', 'Names appearing in multiple PDF files: ' || count(*)] FROM c HAVING count(*) > 0)
SELECT section, item, i::INT AS line_no, l[i + 1] AS line FROM x, unnest(range(len(l))) AS u(i)""",
    "report_duplicates": f"""{_WITH}, g AS (SELECT norm, count(*) AS cnt, min(seq) AS first_seq, list('  Line ' || seq || ': ' || name ORDER BY seq) AS o FROM ordered GROUP BY norm),
s AS (SELECT sum(cnt) AS t, count(*) AS u, count(*) FILTER (cnt > 1) AS d, sum(cnt - 1) AS r FROM g),
n AS (SELECT *, row_number() OVER (ORDER BY cnt DESC, first_seq) AS item FROM g WHERE cnt > 1),
x AS (SELECT 2 AS section, item, list_concat(['--- Group #' || item || ' ---', 'Normalized form: ' || norm, 'Total occurrences: ' || cnt, 'Variations found:'], o) AS l FROM n
  UNION ALL SELECT 1, 0, ['DUPLICATE NAMES REPORT', 'SUMMARY STATISTICS', 'Total names processed: ' || t, 'Unique names (after deduplication): ' || u, 'Duplicate groups found: ' || d,
    'Total duplicates removed: ' || r, 'Duplicate rate: ' || format('{{:.2f}}', r * 100.0::DOUBLE / t) || '%'] FROM s WHERE d > 0)
SELECT section, item, i::INT AS line_no, l[i + 1] AS line FROM x, unnest(range(len(l))) AS u(i)""",
}
SQL["report_review"] = f"""{_WITH}, {validation_ctes(None)},
k AS (SELECT (SELECT count(DISTINCT cluster_id) FROM members) AS c, (SELECT count(*) FROM ill) AS m, (SELECT count(*) FROM patterns) AS p),
m AS (SELECT *, lead(latin) OVER (PARTITION BY cluster_id ORDER BY pos) AS after FROM members),
x AS (SELECT 0 AS section, 0::BIGINT AS item, ['CONSOLIDATED NAMES NEEDING MANUAL REVIEW', 'Total items flagged: ' || (c + m + p), '  - Phonetic variant clusters: ' || c,
    '  - Morphologically invalid: ' || m, '  - Pattern-based corrections: ' || p] AS l FROM k
  UNION ALL SELECT 1, cluster_id, list_concat(['--- Cluster #' || cluster_id || ' (' || count(*) || ' variants) ---'], list('  • ' || name || ' → [' || latin || '] (appears ' || cnt || ' times)' ORDER BY pos),
    ['  Edit distances:'], list('    ' || latin || ' ↔ ' || after || ' = ' || levenshtein({plain("latin")}, {plain("after")}) ORDER BY pos) FILTER (after IS NOT NULL)) FROM m GROUP BY cluster_id
  UNION ALL SELECT 2, item, list_concat(['--- Item #' || item || ' ---', '  Name: ' || name, '  Issues:'], list_transform(reasons, lambda r: '    - ' || r)) FROM (SELECT *, row_number() OVER (ORDER BY seq) AS item FROM ill) y
  UNION ALL SELECT 3, item, ['--- Item #' || item || ' ---', '  Original: ' || name, '  Suggested: ' || suggested, '  Patterns: ' || array_to_string(flags, ', ')] FROM (SELECT *, row_number() OVER (ORDER BY seq) AS item FROM patterns) z
  UNION ALL SELECT 1, 0, ['  (No phonetic variants found)'] FROM k WHERE c = 0 UNION ALL SELECT 2, 0, ['  (No morphologically invalid names found)'] FROM k WHERE m = 0
  UNION ALL SELECT 3, 0, ['  (No pattern-based errors found)'] FROM k WHERE p = 0)
SELECT section, item, i::INT AS line_no, l[i + 1] AS line FROM x, unnest(range(len(l))) AS u(i)"""
_CLUSTERS = f"{_WITH}, {cluster_ctes('listed')}"
SQL |= {
    "phonetic_clusters": f"{_CLUSTERS} SELECT cluster_id, string_agg(name || '=' || latin || '=' || cnt, '|' ORDER BY pos) AS members FROM members GROUP BY cluster_id",
    "cluster_members": f"{_CLUSTERS} SELECT * FROM members",
    "cluster_adjacent_distance": f"{_CLUSTERS}, n AS (SELECT cluster_id, pos, latin, lead(latin) OVER (PARTITION BY cluster_id ORDER BY pos) AS next_latin FROM members) SELECT *, levenshtein({plain('latin')}, {plain('next_latin')}) AS distance FROM n WHERE next_latin IS NOT NULL",
    "invalid_names": f"{_WITH}, {validation_ctes(None)} SELECT name FROM invalid",
    "valid_first_names": f"{_WITH}, {validation_ctes(None)} SELECT seq, name FROM valid",
}
for _m in ("none", "both", "pattern", "phonetic_dict"):
    _v = f"{_WITH}, {validation_ctes(None if _m == 'none' else _m)}"
    SQL[f"validation_valid_{_m}"] = f"{_v} SELECT seq, name FROM valid"
    SQL[f"validation_invalid_{_m}"] = f"{_v} SELECT name FROM invalid"
    SQL[f"validation_summary_{_m}"] = f"""{_v} SELECT (SELECT count(*) FROM now) AS total, (SELECT count(*) FROM now WHERE name <> was) AS corrections, (SELECT count(*) FROM valid) AS valid,
  (SELECT count(*) FROM now) - (SELECT count(*) FROM valid) AS invalid, (SELECT count(DISTINCT cluster_id) FROM members) AS clusters, (SELECT count(*) FROM ill) AS morphology,
  (SELECT count(*) FROM patterns) AS patterns, (SELECT count(DISTINCT cluster_id) FROM members) + (SELECT count(*) FROM ill) + (SELECT count(*) FROM patterns) AS flagged"""
