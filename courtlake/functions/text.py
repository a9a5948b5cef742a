"""Scalar functions over columns, built-in expressions only.

Patterns, limits and class lists are arguments; the defaults are fixed values of the published data model.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data model.
SITE = "https://www.elitigation.sg"
COURT_IN_URL = r"(?i)/gd/s/\d{4}_(SG[A-Z]+)_\d+"
CITATION = r"\[(\d{4})\]\s*(SG[A-Z]+)\s*(\d+)"
PAGE_IN_LINK = r"CurrentPage=(\d+)"
DATE_ATTRIBUTE = r'DecisionDate:"(\d{4}-\d{2}-\d{2})"'
DATE_TEXT = r"Decision Date:\s*(\d{1,2}\s+\w+\s+\d{4})"
NUMBERED = ("Judg-1", "Judg-1-firstpara")
ANCHORS = ("Judg-1", "Judg-1-firstpara", "Judg-2", "Judg-3")
CLASS_PREFIX, HEADING_PREFIX, EXCLUDED = "Judg-", "Judg-Heading-", ("Judg-EOF",)
TABLE_OPEN, TABLE_CLOSE = "\n\n---table---\n", "\n---end-table---\n"
HEADING_WORDS = r"(Facts|Factual\s+Background|Background|Holding|Decision|Reasons|Analysis)"
HEADING_LINE = r"^\s*\*{0,2}\s*" + HEADING_WORDS + r"\b"
META_PREFIX = r"^\s*(Updated summary|Summary so far|Draft summary|Summary\s*\(Facts[^)]*\))\s*:?\s*"
COMMENTARY = (
    r"^\s*(?:The\s+provided\s+(?:new\s+)?excerpts?|As\s+there\s+is\s+no\s+new|The\s+summary\s+remains\s+unchanged"
    r"|Based\s+on\s+the\s+provided|I\s+have\s+initiated\s+the\s+summary|These\s+details\s+are\s+already\s+captured)"
)
ENTITIES = {"lt": "<", "gt": ">", "ge": "≥", "le": "≤", "ne": "≠", "quot": '"', "apos": "'", "nbsp": " ", "amp": "&"}
ENTITY = r"&(amp|lt|gt|ge|le|ne|quot|apos|nbsp|#\d+);"
NAME_FIXES = {"Khoont": "Khoon", "Emplain": "Claim"}
TRAILING_MARKER = r"(?:^|\n)\s*(?:\d+\.\s*\*{0,2}|\*\*\d+\.|\(\w+\)|[•\-*])\s*$"
DISPOSITIVE, ANALYSIS = "conclusion|decision|holding|disposition|order", "issue|analysis|reasoning"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: All white space of Unicode.
SPACES = "\t\n\v\f\r \u0085\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(value: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.btrim(value, F.lit(SPACES))


def rstrip(value: Column) -> Column:
    return F.rtrim(value, F.lit(SPACES))


def lstrip(value: Column) -> Column:
    return F.ltrim(value, F.lit(SPACES))


def blank(value: Column) -> Column:
    return F.coalesce(strip(value) == "", F.lit(True))


def last_index(value: Column, mark: str) -> Column:
    """0-based place of the last `mark`, -1 if there is none."""
    tail = F.substring_index(value, mark, -1)
    return F.when(F.instr(value, mark) > 0, F.length(value) - F.length(tail) - len(mark)).otherwise(-1)


def make_id(*parts: Column, length: int = 12) -> Column:
    """the first hex digits of SHA-256 over the parts joined by a bar."""
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, length)


def court_from_url(url: Column, pattern: str = COURT_IN_URL) -> Column:
    """court code of a judgment url, else empty."""
    return F.upper(F.coalesce(F.regexp_extract(url, pattern, 1), F.lit("")))


def parse_citation(citation: Column, pattern: str = CITATION) -> Column:
    """struct of year, court, number; empty strings if there is no citation."""
    return F.struct(*(F.coalesce(F.regexp_extract(citation, pattern, k), F.lit("")).alias(n) for k, n in enumerate(("year", "court", "number"), 1)))


def pdf_url(citation: Column, site: str = SITE) -> Column:
    """address of the document file, all of the citation percent-encoded; empty without a citation."""
    c = parse_citation(citation)
    slug = F.concat(F.lit("["), c["year"], F.lit("] "), c["court"], F.lit(" "), c["number"])
    return F.when(c["year"] == "", "").otherwise(F.concat(F.lit(f"{site}/gd/gd/"), F.replace(F.url_encode(slug), F.lit("+"), F.lit("%20")), F.lit("/pdf")))


def clean_citation(value: Column) -> Column:
    """without trailing bars, then without outer white space."""
    return strip(F.regexp_replace(value, r"\|+\z", ""))


def decision_date(attribute: Column, visible: Column) -> Column:
    """ISO date from the attribute, else from the visible day month year; empty if there is none or it is invalid."""
    given = F.regexp_extract(F.coalesce(attribute, F.lit("")), DATE_ATTRIBUTE, 1)
    shown = F.regexp_replace(F.regexp_extract(F.coalesce(visible, F.lit("")), "(?U)" + DATE_TEXT, 1), r"(?U)\s+", " ")
    return F.when(given != "", given).otherwise(F.coalesce(F.date_format(F.try_to_date(shown, "d MMM yyyy"), "yyyy-MM-dd"), F.lit("")))


def absolute_url(href: Column, site: str = SITE) -> Column:
    """a link resolved against the site's root."""
    h = strip(href)
    scheme = F.regexp_extract(F.lit(site), "^([a-z]+:)", 1)
    return (
        F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), h).when(h.startswith("//"), F.concat(scheme, h)).when(h.startswith("/"), F.concat(F.lit(site), h))
        .when(h == "", F.lit(site)).otherwise(F.concat(F.lit(site + "/"), h))
    )


def join_case_numbers(values: Column) -> Column:
    """F8: the non-empty values joined by bars."""
    return F.array_join(F.filter(values, lambda v: v != ""), " | ")


def json_list(values: Column) -> Column:
    """JSON text of a list of strings, ", " between them; null for null."""
    return F.concat(F.lit("["), F.array_join(F.transform(values, lambda v: F.regexp_extract(F.to_json(F.array(v)), r"^(?s)\[(.*)\]$", 1)), ", "), F.lit("]"))


def clean_tags(values: Column) -> Column:
    """without empty ones and one outer pair of brackets, as JSON text."""
    inner = F.transform(F.filter(values, lambda v: v != ""), lambda v: F.when(v.startswith("[") & v.endswith("]") & (F.length(v) >= 2), strip(F.regexp_extract(v, r"^(?s)\[(.*)\]$", 1))).otherwise(v))
    return json_list(inner)


def total_pages(href: Column) -> Column:
    """number of listing pages from the link to the last one, else null."""
    return F.regexp_extract(href, PAGE_IN_LINK, 1).try_cast("int")


def normalize_ws(value: Column) -> Column:
    """no-break and em spaces become spaces; nothing is collapsed."""
    return F.translate(value, "\u00a0\u2003", "  ")


def split_paragraph_number(value: Column, class_name: Column, numbered: tuple[str, ...] = NUMBERED) -> Column:
    """struct of number (null if none) and rest; only numbered classes are split."""
    pattern = r"(?Us)^(\d+)\s+(.*)\z"
    own = class_name.isin(*numbered) & value.rlike(pattern)
    number = F.when(own, F.regexp_extract(value, pattern, 1).try_cast("int"))
    return F.struct(number.alias("number"), F.when(own, F.regexp_extract(value, pattern, 2)).otherwise(value).alias("rest"))


def render_table(rows: Column) -> Column:
    """cells joined by bars, rows without content left out, marked as a table; empty if no row is left."""
    lines = F.filter(F.transform(F.filter(rows, lambda r: F.size(r) > 0), lambda r: F.array_join(r, " | ")), lambda t: ~blank(F.replace(t, F.lit("|"), F.lit(""))))
    return F.when(F.size(lines) > 0, F.concat(F.lit(TABLE_OPEN), F.array_join(lines, "\n"), F.lit(TABLE_CLOSE))).otherwise("")


def figure_pair(src: Column, alt: Column, width: Column, height: Column) -> Column:
    """struct of src (hashed if it holds the data) and alt (a placeholder if blank)."""
    s, a, w, h = (strip(F.coalesce(x, F.lit(""))) for x in (src, alt, width, height))
    shown = F.when((w != "") & (h != ""), F.concat(F.lit("[Figure, "), w, F.lit("x"), h, F.lit("]"))).otherwise("[Figure]")
    return F.struct(F.when(s.startswith("data:"), F.concat(F.lit("sha256:"), F.sha2(s, 256))).otherwise(s).alias("src"), F.when(a == "", shown).otherwise(normalize_ws(a)).alias("alt"))


def assemble_text(value: Column, tables: Column, alts: Column) -> Column:
    """text, then the rendered tables, then every figure's alt after a blank line."""
    return F.concat(value, F.array_join(tables, ""), F.array_join(F.transform(alts, lambda a: F.concat(F.lit("\n\n"), a)), ""))


def flag_and_json(values: Column, prefix: str) -> list[Column]:
    """F16: whether a list has items, and its JSON text or null."""
    some = F.coalesce(F.size(values), F.lit(0)) > 0
    return [some.cast("int").alias(f"has_{prefix}"), F.when(some, json_list(values)).alias(f"{prefix}_json")]


def max_summary_chars(fragments: Column) -> Column:
    """4,000 characters and 1,000 more for every full hundred fragments beyond the first."""
    return (4000 + F.greatest(F.lit(0), F.floor((fragments - 100) / 100)) * 1000).cast("int")


def token_budget(limit: Column) -> Column:
    """F18."""
    return F.greatest(F.lit(4096), F.floor(limit / 2) + 1024).cast("int")


def is_heading(class_name: Column) -> Column:
    return F.coalesce(class_name.startswith(HEADING_PREFIX), F.lit(False))


def is_numbered(class_name: Column, numbered: tuple[str, ...] = NUMBERED) -> Column:
    return F.coalesce(class_name.isin(*numbered), F.lit(False))


def render_fragment(class_name: Column, number: Column, value: Column) -> Column:
    """headings get ##, numbered paragraphs [n]; blank text is empty."""
    t = strip(F.coalesce(value, F.lit("")))
    return F.when(t == "", "").when(is_heading(class_name), F.concat(F.lit("## "), t)).when(number.isNotNull(), F.concat(F.lit("["), number.cast("string"), F.lit("] "), t)).otherwise(t)


def score_fragment(has_footnotes: Column, heading: Column, has_table: Column, value: Column) -> Column:
    """footnotes 2, a dispositive heading 3 or an analysis heading 1.5, a table 0.5, length up to 0.5."""
    h = F.coalesce(heading, F.lit(""))
    of_heading = F.when(h.rlike("(?i)" + DISPOSITIVE), 3.0).when(h.rlike("(?i)" + ANALYSIS), 1.5).otherwise(0.0)
    length = F.least(F.length(F.coalesce(value, F.lit(""))), F.lit(500)).cast("double")
    flag = lambda c: F.coalesce(c.cast("int"), F.lit(0)) != 0
    return F.when(flag(has_footnotes), 2.0).otherwise(0.0) + of_heading + F.when(flag(has_table), 0.5).otherwise(0.0) + F.lit(0.1) * length / 100


def case_anchor(name: Column, citation: Column) -> Column:
    """the line that tells a model which case it reads."""
    return F.concat(F.lit("Present case: "), F.coalesce(name, F.lit("")), F.when(F.coalesce(citation, F.lit("")) != "", F.concat(F.lit(" "), citation)).otherwise(""))


def message(template: str, anchor: Column, **values: Column) -> Column:
    """a message for a model: the anchor, a blank line, and a template with {name} for each value."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return F.concat(anchor, F.lit("\n\n"), out)


def strip_meta_prefix(value: Column) -> Column:
    """F22."""
    return F.regexp_replace(value, "(?iU)" + META_PREFIX, "")


def strip_commentary(value: Column, longest: int = 500) -> Column:
    """drop a short, unmarked preface before the first heading line."""

    def cut(found: Column) -> Column:
        at, given = found["at"], found["value"]
        prefix = strip(F.substring(given, F.lit(1), at - 1))
        short = (F.length(prefix) < longest) & ~prefix.startswith("**")
        return F.when((at > 1) & short, lstrip(F.substring(given, at, F.length(given)))).otherwise(given)

    place = lambda v: F.struct(v.alias("value"), F.regexp_instr(v, F.lit("(?imdU)" + HEADING_LINE)).alias("at"))
    return let(value, lambda v: let(place(v), cut))


def fix_artifacts(value: Column) -> Column:
    """underscores between letters, a dollar sign before Charter, named entities, known names."""
    out = F.regexp_replace(value, "(?<=[A-Za-z])_(?=[A-Za-z])", "")
    out = F.regexp_replace(out, r"(?i)(?<=[a-z'\s])\$Charter\b", "Charter")
    for name, sign in ENTITIES.items():  # the ampersand comes last, so that nothing is decoded twice
        out = F.replace(out, F.lit(f"&{name};"), F.lit(sign))
    for wrong, right in NAME_FIXES.items():
        out = F.replace(out, F.lit(wrong), F.lit(right))
    return out


def _ended(value: Column) -> Column:
    return let(value, lambda v: F.when((v != "") & ~v.rlike(r"[.:!?]\z"), F.concat(v, F.lit("."))).otherwise(v))


def _without_marker(value: Column) -> Column:
    """Text without a trailing list marker, closed by a period; null if there is no marker or nothing else."""
    marker = "(?U)" + TRAILING_MARKER

    def cut(base: Column) -> Column:
        shorter = lambda c: F.when((c != "") & (F.length(c) < F.length(base)), c)
        return F.when(base.rlike(marker), let(_ended(rstrip(F.regexp_replace(base, marker, ""))), shorter))

    return let(rstrip(value), cut)


def trim_trailing_incomplete(value: Column) -> Column:
    """F25."""
    return let(value, lambda v: F.coalesce(_without_marker(v), v))


def trim_to_complete(value: Column, limit: Column) -> Column:
    """within the limit as F25; else cut there, at a complete item or sentence."""

    def cut(chunk: Column) -> Column:
        half = limit * F.lit(0.5)
        upto = lambda at, end: F.when(at > half, end(F.substring(chunk, F.lit(1), at)))
        tries = [_without_marker(chunk), let(last_index(chunk, ". "), lambda at: upto(at, lambda t: F.concat(t, F.lit("."))))]
        for mark in ("\n\n", "\n", ". ", ".\n"):
            tries.append(let(last_index(chunk, mark), lambda at: upto(at, lambda t: _ended(rstrip(t)))))
        return F.coalesce(*tries, F.concat(rstrip(chunk), F.lit(".")))

    whole = lambda v: F.when(F.length(v) <= limit, trim_trailing_incomplete(v)).otherwise(let(F.substring(v, F.lit(1), limit), cut))
    return let(value, whole)


def min_words(fragments: Column) -> Column:
    """F28."""
    return F.when(fragments <= 20, 20).otherwise(F.greatest(F.lit(50), F.least(F.floor(fragments / 5), F.lit(200)))).cast("int")


def word_count(value: Column, most: int = -1) -> Column:
    """Number of words; counting ends at `most` if that is positive."""
    return let(strip(value), lambda s: F.when(s == "", 0).otherwise(F.size(F.split(s, r"(?U)\s+", most))))


def fewer_words(value: Column, least: Column, most: int = 200) -> Column:
    """Whether a text has fewer than `least` words; `least` is at most `most`, so no more have to be counted."""
    return word_count(value, most + 1) < least


def smell_test(summary: Column, fragments: Column) -> Column:
    """struct of passed, issues (names of failed checks in a fixed order), severity."""

    def issues(s: Column) -> Column:
        checks = {
            "too short": fewer_words(s, min_words(fragments)),
            "no structural heading": ~s.rlike("(?imdU)" + HEADING_LINE),
            "commentary leak": F.substring(s, 1, 500).rlike("(?imdU)" + COMMENTARY),
            "no terminal punctuation": ~s.rlike(r"""[.!?:)\]"'`]\z"""),
            "trailing list marker": s.rlike("(?U)" + TRAILING_MARKER),
            "HTML entity": s.rlike(ENTITY),
            "underscore in name": s.rlike("[A-Za-z]_[A-Za-z]"),
        }
        found = F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in checks.items())), lambda x: x.isNotNull())
        return F.when(s == "", F.array(F.lit("empty summary"))).otherwise(found)

    def verdict(found: Column) -> Column:
        passed = F.size(found) == 0
        return F.struct(passed.alias("passed"), found.alias("issues"), F.when(passed, "pass").otherwise("fail").alias("severity"))

    return let(let(strip(F.coalesce(summary, F.lit(""))), issues), verdict)


def age_seconds(last_attempt: Column, now: Column) -> Column:
    return F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(F.try_to_timestamp(last_attempt))


def extract_quarantined(count: Column, last_attempt: Column, now: Column, failures: int = 3, seconds: int = 86_400) -> Column:
    """enough failures, the last less than a day ago; a bad timestamp counts as not quarantined."""
    return F.coalesce((count >= failures) & (age_seconds(last_attempt, now) < seconds), F.lit(False))


def summary_tier(count: Column, last_attempt: Column, now: Column, alternative: int = 3, hard: int = 6, seconds: int = 604_800) -> Column:
    """primary, alternative (no time limit), or blocked for a week after the last of many failures."""
    n = F.coalesce(count, F.lit(0))
    recent = F.coalesce(age_seconds(last_attempt, now) < seconds, F.lit(False))
    return F.when(n < alternative, "primary").when((n >= hard) & recent, "blocked").otherwise("alternative")


def model_route(tier: Column, primary: str, alternative: str) -> Column:
    """The model for a tier; the same rule routes endpoints."""
    return F.when(tier == "primary", primary).otherwise(alternative)


def route(tier: Column, primary: tuple[str, str], alternative: tuple[str, str]) -> Column:
    """Struct of model and endpoint for a tier."""
    return F.struct(*(model_route(tier, a, b).alias(n) for n, a, b in zip(("model", "endpoint"), primary, alternative, strict=True)))
