"""DuckDB SQL for the column functions on text: each takes SQL of a text and gives SQL."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from loamwork.functions import text as T

SPACE, WORD, _AFTER = T.SPACE, T.WORD, T._AFTER


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def replaced(t: str, pattern: str, to: str) -> str:
    return f"regexp_replace({t}, {quoted(pattern)}, {quoted(to)}, 'g')"


def matches(t: str, pattern: str) -> str:
    return f"regexp_matches({t}, {quoted(pattern)})"


def strip(t: str) -> str:
    return replaced(t, f"^{SPACE}+|{SPACE}+$", "")


def words(t: str) -> str:
    return f"list_filter(regexp_split_to_array({t}, {quoted(SPACE + '+')}), lambda w0: w0 <> '')"


def is_blank(t: str) -> str:
    return f"NOT {matches(t, SPACE.replace('[', '[^', 1))}"


def printable_ratio(t: str) -> str:
    return f"CASE WHEN {is_blank(t)} THEN 1.0::DOUBLE ELSE length({replaced(t, '[^\\x20-\\x7E]', '')})::DOUBLE / length({t}) END"


def per_line(t: str, change) -> str:
    return f"array_to_string(list_transform(string_split({t}, chr(10)), lambda x: {change('x')}), chr(10))"


def kept_lines(t: str, test) -> str:
    return f"array_to_string(list_filter(string_split({t}, chr(10)), lambda x: {test('x')}), chr(10))"


def fix_mashed_words(t: str) -> str:
    for a, b in (("[a-z]", "[A-Z]"), ("[A-Za-z]", "[0-9]"), ("[0-9]", "[A-Za-z]")):
        t = replaced(t, f"({a})({b})", r"\1 \2")
    return t


def fix_split_words(t: str) -> str:
    return replaced(t, r"([A-Za-z]{2,})-\s*\n\s*([A-Za-z]{2,})", r"\1\2")


def keep_printable(t: str) -> str:
    return per_line(t, lambda x: f"trim({replaced(replaced(x, '[^\\x20-\\x7E]', ' '), ' +', ' ')})")


def merge_broken_lines(t: str) -> str:
    return replaced(per_line(t, strip), r"(?m)^([^\n]{0,78}[^\n.!?:;])\n(\p{Ll}[^\n]*)", r"\1 \2")


def orientation_score(c: str) -> str:
    found, lower = f"regexp_extract_all({c}, '{WORD}')", f"regexp_extract_all(lower({c}), '{WORD}')"
    listed = ", ".join(f"'{w}'" for w in T.REVERSED_WORDS)
    ratio = f"(len(list_filter({lower}, lambda w: w IN ({listed})))::DOUBLE / greatest(len({lower}), 1))"
    return (
        f"CASE WHEN length({c}) < 2 THEN 0.0::DOUBLE ELSE least(1.0::DOUBLE, CASE WHEN regexp_matches({c}, '[a-z][A-Z]{_AFTER}') THEN 0.8::DOUBLE ELSE 0 END + 0.5::DOUBLE * {ratio} + CASE WHEN {ratio} >= 0.3::DOUBLE THEN 0.3::DOUBLE ELSE 0 END"
        f" + CASE WHEN regexp_matches({c}, '^[.,;:]') AND NOT regexp_matches({c}, '[.,!?;:]$') AND length({c}) > 3 THEN 0.4::DOUBLE ELSE 0 END"
        f" + CASE WHEN regexp_matches({c}, '[a-z]{{3}}[A-Z]{_AFTER}') THEN 0.4::DOUBLE ELSE 0 END + 0.3::DOUBLE * least(len(list_filter({found}, lambda w: regexp_matches(w, '^[a-z]+[A-Z]$'))), 3)) END"
    )


def fix_reversed(t: str) -> str:
    fixed = lambda c: f"CASE WHEN {orientation_score(c)} >= 0.35::DOUBLE THEN reverse({c}) ELSE {c} END"
    cells = lambda x: f"array_to_string(list_transform(list_transform(string_split({x}, '|'), lambda c: {strip('c')}), lambda c: {fixed('c')}), ' | ')"
    return per_line(t, lambda x: f"CASE WHEN {is_blank(x)} THEN {x} WHEN contains({x}, '|') THEN {cells(x)} ELSE list_transform([{strip(x)}], lambda c: {fixed('c')})[1] END")


def remove_noise(t: str) -> str:
    for pattern, to in ((r"\f", "\n"), (r"[\x{200B}-\x{200F}\x{FEFF}]", ""), ("-{5,}", ""), ("_{5,}", "")):
        t = replaced(t, pattern, to)
    return kept_lines(t, lambda x: f"{is_blank(x)} OR {matches(x, '[\\p{L}\\p{N}_]')}")


def collapse_space(t: str) -> str:
    single = lambda x: strip(replaced(x, SPACE + "+", " "))
    return replaced(per_line(f"replace({t}, chr(9), '    ')", lambda x: f"CASE WHEN contains({x}, '|') THEN {strip(x)} ELSE {single(x)} END"), r"\n{4,}", "\n\n")


def replace_typography(t: str) -> str:
    return reduce(lambda c, kv: f"replace({c}, {quoted(kv[0])}, {quoted(kv[1])})", T.REPLACEMENTS.items(), t)


def fill_empty_cells(t: str) -> str:
    cells = lambda x: f"array_to_string(list_transform(string_split({x}, '|'), lambda c: CASE WHEN {is_blank('c')} THEN 'N/A' ELSE {strip('c')} END), ' | ')"
    return per_line(t, lambda x: f"CASE WHEN contains({x}, '|') THEN {cells(x)} ELSE {x} END")


#: The repairs in their fixed order.
CLEANING = [keep_printable, fix_mashed_words, merge_broken_lines, fix_reversed, remove_noise, collapse_space, replace_typography, fix_split_words, fill_empty_cells]


def clean_company_name(t: str) -> str:
    t = strip(f"coalesce({t}, '')")
    for suffix in T.COMPANY_SUFFIXES:
        t = strip(replaced(t, suffix.replace(".", r"\.") + "$", ""))
    return t


def safe_file_name(t: str) -> str:
    c = replaced(replaced(t, r"[/\\:]", "_"), '[*?"<>|]', "")
    c = f"replace({replaced(replaced(strip(c), r'^\.+|\.+$', ''), SPACE + '+', ' ')}, ' ', '_')"
    return f"CASE WHEN coalesce({t}, '') = '' THEN 'Unknown' ELSE {c} END"


def contains_any(t: str, phrases: Iterable[str]) -> str:
    return "(" + " OR ".join(f"contains({t}, {quoted(p)})" for p in phrases) + ")"


def category_by_hits(t: str) -> str:
    e, s, g = ("(" + " + ".join(f"contains(lower({t}), {quoted(w)})::INT" for w in ws) + ")" for ws in T.CATEGORY_WORDS.values())
    first, second, third = map(quoted, T.CATEGORY_WORDS)
    return f"CASE WHEN {e} >= {s} AND {e} >= {g} THEN {first} WHEN {s} >= {g} THEN {second} ELSE {third} END"


def category_by_order(t: str) -> str:
    (first, e), (second, s) = T.FIRST_CATEGORY_WORDS.items()
    return f"CASE WHEN {contains_any(f'lower({t})', e)} THEN {quoted(first)} WHEN {contains_any(f'lower({t})', s)} THEN {quoted(second)} ELSE {quoted([*T.CATEGORY_WORDS][-1])} END"


def headings(source: str, phrases: Iterable[str] = T.HEADING_WORDS) -> str:
    """doc_id, line_index, line (stripped), confidence and level of all lines of ``source`` (doc_id, t), as SQL of a query."""
    upper = f"({matches('line', '\\p{Lu}')} AND NOT {matches('line', '\\p{Ll}')})"
    points = [
        (f"{upper} AND n >= 2", 40), (f"len(list_filter(w, lambda x: {matches('x', '^\\p{Lu}')})) >= n * 0.7::DOUBLE AND n >= 2", 30), (contains_any("lower(line)", phrases), 25),
        (f"n <= 8 AND len({words('after')}) > 15", 20), (matches("line", ":$"), 15), (matches("line", "^[A-Z0-9]+[.)]" + SPACE + "+[A-Z]"), 25),
        (f"before <> '' AND {is_blank('before')} AND after <> '' AND n <= 10", 15),
    ]
    total = " + ".join(f"CASE WHEN {c} THEN {k} ELSE 0 END" for c, k in points)
    return f"""(
      WITH s AS (SELECT doc_id, string_split(t, chr(10)) AS ls FROM {source}), u AS (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM s),
      l AS (SELECT doc_id, i - 1 AS line_index, {strip('ls[i]')} AS line, CASE WHEN i > 1 THEN ls[i - 1] END AS before, ls[i + 1] AS after FROM u),
      c AS (SELECT *, {words('line')} AS w, len({words('line')}) AS n FROM l)
      SELECT doc_id, line_index, line, CASE WHEN length(line) < 3 OR {matches('line', '^([0-9]+$|(?i:page) [0-9]+)')} THEN 0 ELSE {total} END AS confidence,
             CASE WHEN {upper} AND n <= 4 THEN 1 WHEN n <= 6 THEN 2 ELSE 3 END AS level FROM c)"""
