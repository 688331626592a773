"""Text expressions: sections, mentions, counts, snippets and roles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import dims

MENTION = r"\[\[([^\]]+)\]\]"
_BLANKS = " \t\n\r\f\v"


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(c, F.lit(_BLANKS))


def quoted(text: str) -> str:
    """A regex that matches the text itself."""
    return r"\Q" + text.replace(r"\E", r"\E\\E\Q") + r"\E"


def replacement(c: Column | str) -> Column:
    """A text as the replacement of a regex, free of group references."""
    c = F.lit(c) if isinstance(c, str) else c
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))


def body(content: Column) -> Column:
    """What stands before the finance header; all where there is none."""
    return F.split(content, dims.FINANCE_HEADER, 2)[0]


def finance(content: Column) -> Column:
    """The finance header and all behind it; empty where there is none."""
    return F.coalesce(F.substring(content, F.char_length(body(content)) + 1, F.char_length(content)), F.lit(""))


def loose_section(content: Column, title: str) -> Column:
    """The last piece that starts with the title when cut at every ``## ``, so also at ``### ``; empty if there is none."""
    pieces = F.split(content, "## ")
    return F.coalesce(F.try_element_at(F.filter(pieces, lambda x: x.startswith(title)), F.lit(-1)), F.lit(""))


def exact_section(text: Column, title: str, until: str = r"\n## ") -> Column:
    """The first section under ``## title``, up to a header of the same level; empty if there is none."""
    return F.regexp_extract(text, rf"(?s)## {quoted(title)}\n(.*?)(?={until}|\z)", 1)


def mentions(c: Column) -> Column:
    """All linked names in order, repeats included."""
    return F.regexp_extract_all(c, F.lit(MENTION), F.lit(1))


def linked_count(c: Column, term: str) -> Column:
    return F.regexp_count(c, F.lit(quoted(f"[[{term}]]")))


def bare_pattern(term: str) -> str:
    return rf"(?<!\[\[){quoted(term)}(?!\]\])"


def taggable_pattern(term: str) -> str:
    return bare_pattern(term) + r"(?![A-Za-z\x{4E00}-\x{9FFF}])"


def bare_count(c: Column, term: str) -> Column:
    return F.regexp_count(c, F.lit(bare_pattern(term)))


def taggable_count(c: Column, term: str) -> Column:
    return F.regexp_count(c, F.lit(taggable_pattern(term)))


def tag_mentions(c: Column, term: str) -> Column:
    return F.regexp_replace(c, F.lit(taggable_pattern(term)), replacement(f"[[{term}]]"))


def snippets(c: Column, term: str, reach: int = 30, most: int = 3) -> Column:
    """The first bare mentions with so many characters on either side, on one line, within dots. Windows may overlap.

    The text is cut at the term once. A window spans at most reach + 1 pieces on a side, since each cut stands for a character or more.
    """

    def of(parts: Column) -> Column:
        gaps = F.when(F.size(parts) > 1, F.sequence(F.lit(1), F.size(parts) - 1)).otherwise(F.array().cast("array<int>"))
        bare = F.filter(gaps, lambda i: ~(F.element_at(parts, i).endswith("[[")) & ~(F.element_at(parts, i + 1).startswith("]]")))

        def one(i: Column) -> Column:
            first = F.greatest(F.lit(1), i - reach)
            left = F.right(F.array_join(F.slice(parts, first, i - first + 1), term), F.lit(reach))
            right = F.left(F.array_join(F.slice(parts, i + 1, F.lit(reach + 1)), term), F.lit(reach))
            return F.concat(F.lit("..."), strip(F.replace(F.concat(left, F.lit(term), right), F.lit("\n"), F.lit(" "))), F.lit("..."))

        return F.transform(F.slice(bare, 1, most), one)

    # The lambda binds the pieces, so that they are made once for a text.
    return F.transform(F.array(F.split(c, quoted(term), -1)), of)[0]


def role(supply_chain: Column, name: Column) -> Column:
    """The first mark among the last characters before the name's first occurrence; `related` without one."""
    at = F.position(name, supply_chain)
    before = F.right(F.left(supply_chain, at - 1), F.lit(dims.ROLE_REACH))
    found = None
    for label, mark in dims.ROLE_MARKS:
        hit = (at > 0) & before.contains(mark)
        found = F.when(hit, label) if found is None else found.when(hit, label)
    return found.otherwise("related")


def cjk_heavy(name: Column) -> Column:
    return F.regexp_count(name, F.lit(r"[\x{4E00}-\x{9FFF}]")) > dims.CJK_SHARE * F.char_length(name)


def metadata(content: Column, key: str) -> Column:
    """The value of the first ``**key:** value`` line; null if there is none or it is empty."""
    return F.nullif(strip(F.regexp_extract(content, rf"(?m)^\s*\*\*{quoted(key)}:\*\*(.*)$", 1)), F.lit(""))


def amount(text: Column) -> Column:
    """A number as reports print it: thousands separators, a unit behind it; null for a dash or N/A."""
    return F.regexp_replace(F.regexp_extract(text, r"(-?[\d,]+(?:\.\d+)?)", 1), ",", "").try_cast("decimal(18,2)")


def file_name(name: Column) -> Column:
    """Free of characters that file systems refuse."""
    return strip(F.regexp_replace(name, r'[<>:"/\\|?*]', ""))


def page_name(tag: Column) -> Column:
    return F.translate(tag, " /", "__")
