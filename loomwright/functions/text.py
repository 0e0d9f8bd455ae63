"""Text rules as column expressions: spoken characters, punctuation runs, endings, safe names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sets of sentence and clause marks, and brackets that count as spoken.
STRONG_STOPS = "。？！.?!"
WEAK_STOPS = "，；、,;:"
DIFF_STRONG_ENDINGS = "。！？!?…"
DIFF_WEAK_ENDINGS = "，、；：,"
SPOKEN_BRACKETS = "<>()《》（）"

SILENT = rf"(?U)[\s\x1c-\x1f\p{{P}}\p{{S}}&&[^{SPOKEN_BRACKETS}]]"


def _marks(chars: str) -> str:
    return "[" + "".join("\\" + c if c in ".?!,;:" else c for c in chars) + "]"


def is_silent(char: Column) -> Column:
    """White space, punctuation or symbol, but not one of the spoken brackets."""
    return char.rlike(f"^{SILENT}$")


def spoken(text: Column) -> Column:
    """The text without silent characters."""
    return F.regexp_replace(text, SILENT, "")


def _blank(run: Column) -> Column:
    """Empty, or white space alone."""
    return run.rlike(r"^(?U)[\s\x1c-\x1f]*$")


def run_after(text: Column, position: Column) -> Column:
    """The silent run right after a 0-based position; empty if it holds nothing visible."""
    run = F.regexp_extract(F.substring(text, position + 2, F.length(text)), f"^{SILENT}+", 0)
    return F.when(_blank(run), "").otherwise(run)


def pause_category(run: Column) -> Column:
    """strong or weak by the first such mark of a run, else no_punc."""
    first = F.regexp_extract(run, f"({_marks(STRONG_STOPS)}|{_marks(WEAK_STOPS)})", 1)
    return F.when(first == "", "no_punc").when(first.rlike(_marks(STRONG_STOPS)), "strong").otherwise("weak")


def ends_unmarked(word: Column) -> Column:
    """No strong or weak mark in the run of punctuation that ends a word: its :func:`pause_category` is no_punc."""
    return ~word.rlike(_marks(STRONG_STOPS + WEAK_STOPS) + r"\p{P}*$")


def boundary_kind(run: Column) -> Column:
    """strong if any mark of a visible run is strong, else weak; null without a visible run."""
    return F.when(_blank(run), None).when(run.rlike(_marks(STRONG_STOPS)), "strong").otherwise("weak")


def ending_kind(text: Column) -> Column:
    """How a transcript ends: strong, weak or other."""
    last = F.right(F.rtrim(text), F.lit(1))
    return F.when(last.isin(*DIFF_STRONG_ENDINGS), "strong").when(last.isin(*DIFF_WEAK_ENDINGS), "weak").otherwise("other")


def safe_stem(name: Column) -> Column:
    """Runs of characters outside letters, digits, dot, underscore and hyphen as one underscore; ends stripped."""
    clean = F.regexp_replace(F.regexp_replace(name, r"[^A-Za-z0-9._-]+", "_"), r"^[._]+|[._]+$", "")
    return F.when(clean == "", "audio").otherwise(clean)


def manifest_path(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def unsafe_path(path: Column) -> Column:
    """Absolute, or with a step to the parent."""
    p = manifest_path(path)
    return p.startswith("/") | p.rlike(r"(^|/)\.\.(/|$)") | p.rlike(r"^[A-Za-z]:/")


def extension(name: Column) -> Column:
    """Lower-cased, with a leading dot."""
    low = F.lower(F.trim(name))
    return F.when(low.startswith("."), low).otherwise(F.concat(F.lit("."), low))


def first_mismatch(a: Column, b: Column) -> Column:
    """0-based place of the first code point in which two texts differ (the shorter one's length if it starts the other); null for equal ones."""
    x, y = F.split(a, ""), F.split(b, "")
    unequal = F.zip_with(x, y, lambda p, q: ~p.eqNullSafe(q))
    return F.when(a == b, None).otherwise(F.array_position(unequal, True).cast("int") - 1)


def json_arguments(raw: Column) -> Column:
    """The members of a JSON object as text; empty for a null, blank or broken text, or JSON of another kind."""
    found = F.from_json(F.btrim(raw), "map<string,string>")
    return F.coalesce(found, F.create_map().cast("map<string,string>"))
