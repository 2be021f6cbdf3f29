"""Text and line functions: each takes and returns Columns, without Python on the executors.

Patterns use ``(?U)`` so that white space, digits, letters and word borders are Unicode's. A null text counts as empty.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Line ends other than the line feed: of str.splitlines in Python, which the layout rules are defined by.
LINE_ENDS = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"

#: White space as (?U)\\s has it: trimming it by name is native, and many times faster than a pattern.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

#: White space and line ends other than the blank and the line feed; looked for by bytes, which a class of them in a pattern is ten times slower than.
ODD_SPACES = SPACES.replace("\n", "").replace(" ", "") + "\x1c\x1d\x1e"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it: keeps long compositions linear."""
    return F.get(F.transform(F.array(col(value)), body), 0)


def strip(c) -> Column:
    return F.btrim(F.coalesce(col(c), F.lit("")), F.lit(SPACES))


def rstrip(c) -> Column:
    return F.rtrim(F.coalesce(col(c), F.lit("")), F.lit(SPACES))


def sub(c, pattern: str, to: str) -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(to))


def clean_text(c) -> Column:
    """Null to empty, no NUL, line feeds only, runs of blanks to one, three line feeds or more to two, stripped."""
    x = F.replace(F.coalesce(col(c), F.lit("")), F.lit("\0"), F.lit(""))
    x = sub(sub(x, "\r\n?", "\n"), "[ \t]{2,}|\t", " ")
    return strip(sub(x, "\n{3,}", "\n\n"))


def clean_line(c) -> Column:
    """Stripped, each run of white space one space."""
    return strip(sub(F.coalesce(col(c), F.lit("")), r"(?U)\s{2,}|[^\S ]", " "))


def split_lines(c) -> Column:
    """The lines, as str.splitlines has them: no empty one after a final line end, none of an empty text."""
    x = F.coalesce(col(c), F.lit(""))
    return F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(x, rf"(?:{LINE_ENDS})\z", ""), LINE_ENDS))


def tidy_lines(c) -> Column:
    """The lines with line feeds only, white space at their ends and a final line end taken off; most texts need no split."""
    odd = lambda x: F.contains(x, F.lit(" \n")) | x.endswith(" ") | any_within(x, ODD_SPACES)
    return let(F.coalesce(col(c), F.lit("")), lambda x: F.when(odd(x), F.array_join(F.transform(split_lines(x), rstrip), "\n")).otherwise(sub(x, r"\n\z", "")))


def unmarked(letters: str = "") -> tuple[str, str]:
    """Letters with diacritics, and what stands for them: made from Unicode's canonical decompositions.

    ``letters`` are pairs of further letters and their replacements.
    """
    source, target = list(letters[::2]), list(letters[1::2])
    for point in (*range(0xC0, 0x600), *range(0x1E00, 0x2000)):
        c = chr(point)
        parts = unicodedata.normalize("NFD", c)
        bare = unicodedata.normalize("NFC", "".join(x for x in parts if unicodedata.category(x) != "Mn"))
        if bare != c and len(bare) == 1:
            source.append(c)
            target.append(bare)
    return "".join(source), "".join(target)


_WITH_D, _PLAIN = unmarked("ĐDđd"), unmarked()


def strip_marks(c, fold_d: bool = True) -> Column:
    """Without diacritics; đ becomes d as well unless ``fold_d`` is false."""
    return sub(F.translate(F.coalesce(col(c), F.lit("")), *(_WITH_D if fold_d else _PLAIN)), r"\p{Mn}+", "")


def match_key(c, spaces: bool = True) -> Column:
    """What keyword rules compare: no diacritics, lower case, only letters, digits and single spaces."""
    x = sub(F.lower(strip_marks(clean_line(c))), "[^a-z0-9]+", " ")
    x = F.trim(x)
    return x if spaces else F.replace(x, F.lit(" "), F.lit(""))


def slug(c) -> Column:
    x = sub(sub(F.lower(strip_marks(c, False)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(x == "", "untitled").otherwise(x)


def name_key(c) -> Column:
    return F.replace(slug(c), F.lit("-"), F.lit(""))


def file_name(path) -> Column:
    return F.element_at(F.split(sub(F.coalesce(col(path), F.lit("")), "/+$", ""), "/"), -1)


def file_stem(path) -> Column:
    return sub(file_name(path), r"(?<=.)\.[^.]+$", "")


def file_ext(path) -> Column:
    """The suffix in lower case, with its dot; empty if there is none."""
    return F.lower(F.regexp_extract(file_name(path), r"(?<=.)(\.[^.]+)$", 1))


def safe_name(path, longest: int = 120) -> Column:
    """A file name that any system takes; longer ones end in the first eight digits of the stem's MD5."""
    x = sub(sub(file_stem(path), r'[<>:"/\\|?*]+', "_"), r"(?U)\s+", "_")
    x = sub(x, "^[._ ]+|[._ ]+$", "")
    cut = F.concat(F.substring(x, 1, longest), F.lit("_"), F.substring(F.md5(x.cast("binary")), 1, 8))
    return F.when(F.length(x) > longest, cut).when(x == "", "untitled").otherwise(x)


def layout_key(c) -> Column:
    """Lower case with single spaces, diacritics kept: what the layout keywords are searched in."""
    return clean_line(F.lower(F.coalesce(col(c), F.lit(""))))


def caps_ratio(c) -> Column:
    letters = F.regexp_count(col(c), F.lit(r"\p{L}"))
    return F.when(letters > 0, F.regexp_count(col(c), F.lit(r"\p{Lu}")) / letters).otherwise(0.0)


def repeat_key(c) -> Column:
    """A line as compared across pages: lower case, digits as one #."""
    return sub(F.lower(clean_line(c)), r"(?U)\d+", "#")


def clean_title(c) -> Column:
    x = sub(sub(F.coalesce(col(c), F.lit("")), r"(?i)<br\s*/?>", " "), "<[^>]+>", " ")
    return sub(clean_line(sub(x, "[*_`#]", "")), r"^[ |]+|[ |]+$", "")


def title_key(c) -> Column:
    x = sub(sub(F.coalesce(col(c), F.lit("")), r"(?i)<br\s*/?>", " "), "<[^>]+>", " ")
    return F.upper(clean_line(sub(x, "[*_`#]", "")))


def first_non_empty(*values) -> Column:
    return F.coalesce(*(F.when(col(v) != "", col(v)) for v in values))


NUMBER_MARK = r"\d+\.\d+(?:\.\d+)*\.?|\d+[.)]"
ROMAN_MARK = "[IVXLCDMivxlcdm]+"
LETTER_MARK = "[a-zA-ZđĐ]"


def marker(c) -> Column:
    """struct(type, marker, content): a leading number, roman numeral or letter, in this order; else null, '', the line."""
    return let(clean_line(c), _marker)


def _marker(x: Column) -> Column:
    def found(kind: str, pattern: str) -> Column:
        return F.when(x.rlike(pattern), F.struct(F.lit(kind).alias("type"), F.regexp_extract(x, pattern, 1).alias("marker"), strip(F.regexp_extract(x, pattern, 2)).alias("content")))

    none = F.struct(F.lit(None).cast("string").alias("type"), F.lit("").alias("marker"), x.alias("content"))
    return F.coalesce(found("number", rf"(?Ud)^({NUMBER_MARK})\s+(.+)$"), found("roman", rf"(?Ud)^({ROMAN_MARK})[.)]\s+(.+)$"), found("letter", rf"(?Ud)^({LETTER_MARK})[.)/]\s+(.+)$"), none)


def starts_item(c) -> Column:
    """Whether the line begins a list item."""
    return clean_line(c).rlike(rf"(?U)^(?:[-+•]\s+|(?:{NUMBER_MARK})\s+|{ROMAN_MARK}[.)]\s+|{LETTER_MARK}[.)/]\s+)")


def any_prefix(c, prefixes) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | col(c).startswith(p)
    return out


def any_within(c, parts) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(col(c), F.lit(p))
    return out
