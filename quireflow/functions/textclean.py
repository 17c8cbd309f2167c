"""Markdown and OCR-text clean-up as Column expressions. White space is Unicode's, as in the source texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that end a line for good, that begin one, and the starts of block elements.
CLOSING = "。！？)>|\";.；"
LEADING = "【(▲"
BLOCK_STARTS = ["#", "<div", "<table", "<img", "<tr"]
# Bracket pairs that mirror each other, opening then closing.
OPENING, MIRRORED = "([{<（《【「", ")]}>）》】」"
# Last characters of a finished fragment.
FINISHED = "。！？.)）】【」…\"'"

# Five bracketed groups or more in a row, and rows of delimiters. No part of a match is tried again, so long runs need no deep stack.
PAREN_RUN, DELIMITER_ROW = r"(?U)(?:\([^)]++\)\s*+){5,}+", r"(?mdU)^[-=*_○×☐]{3,}\s*$"


#: A character of white space, as a pattern.
WHITE = r"\s"


def strip(c: Column) -> Column:
    """Has one parameter: to a function of two ``transform`` hands the place in the array as well."""
    return strip_of(c, WHITE)


def strip_of(c: Column, white: str) -> Column:
    return F.regexp_replace(c, rf"(?U)\A{white}+|{white}+\z", "")


def lstrip(c: Column) -> Column:
    return lstrip_of(c, WHITE)


def lstrip_of(c: Column, white: str) -> Column:
    return F.regexp_replace(c, rf"(?U)\A{white}+", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+\z", "")


def lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def is_block_element(c: Column) -> Column:
    left = lstrip(c)
    out = F.lit(False)
    for start in BLOCK_STARTS:
        out = out | F.startswith(left, F.lit(start))
    return out


def strip_bbox_lines(c: Column) -> Column:
    """Without lines whose first characters, white space apart, are ``bbox:``."""
    return F.array_join(F.filter(lines(c), lambda x: ~x.rlike(r"(?U)\A\s*bbox:")), "\n")


def strip_trailing_bbox(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\n*bbox:\[\d+,\s*\d+,\s*\d+,\s*\d+\]\s*\z", ""))


def collapse_newlines(c: Column) -> Column:
    return F.regexp_replace(c, r"\n{3,}", "\n\n")


def remove_paren_runs(c: Column) -> Column:
    return F.regexp_replace(c, PAREN_RUN, "")


def remove_delimiter_rows(c: Column) -> Column:
    """The run of white space after a row goes too, so blank lines that follow go with it."""
    return F.regexp_replace(c, DELIMITER_ROW, "")


def bound(c: Column, f) -> Column:
    """f(c), with c evaluated once however often f uses it, inside lambda functions too."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def shrink_line(c: Column) -> Column:
    """A line that repeats one unit three times or more becomes the shortest such unit.

    Only divisors of the length can be a unit's. A text repeats a unit of p characters if it equals itself moved on by p, so
    each divisor costs one comparison and no text is built up again.
    """

    def shrink(t: Column) -> Column:
        n = F.length(t)
        small = F.filter(F.sequence(F.lit(1), F.greatest(F.floor(F.sqrt(n)).cast("int"), F.lit(1))), lambda k: n % k == 0)
        # divisors in ascending order: the small ones, and those that they leave
        sizes = F.concat(small, F.reverse(F.transform(small, lambda k: F.floor(n / k).cast("int"))))
        units = F.filter(sizes, lambda p: (p * 3 <= n) & (F.left(t, n - p) == F.substr(t, p + 1)))
        return F.when(n < 3, t).otherwise(F.coalesce(F.left(t, F.get(units, F.lit(0))), t))

    return bound(c, shrink)


def collapse_duplicates(c: Column) -> Column:
    """The text's unit if it is one unit three times or more, else each line's."""
    by_line = lambda t: F.array_join(F.transform(lines(t), shrink_line), "\n")
    return bound(c, lambda t: bound(shrink_line(t), lambda whole: F.when(whole != t, whole).otherwise(by_line(t))))


def normalise_markdown(c: Column) -> Column:
    """Strips lines, drops blank ones, and joins neighbours: nothing between them if the first is open and neither is a block element, else a blank line."""
    kept = F.filter(F.transform(lines(c), strip), lambda x: x != "")

    def add(acc: Column, x: Column) -> Column:
        last, text = acc["last"], acc["text"]
        glue = ~F.right(last, F.lit(1)).isin(*CLOSING) & ~F.left(x, F.lit(1)).isin(*LEADING) & ~is_block_element(last) & ~is_block_element(x)
        return F.struct(F.when(text == "", x).when(glue, F.concat(text, x)).otherwise(F.concat(text, F.lit("\n\n"), x)).alias("text"), x.alias("last"))

    return F.aggregate(kept, F.struct(F.lit("").alias("text"), F.lit("").alias("last")), add, lambda acc: acc["text"])


def full_clean(c: Column) -> Column:
    """Paren runs, delimiter rows, repetitions and newline runs, then a strip."""
    return strip(collapse_newlines(collapse_duplicates(remove_delimiter_rows(remove_paren_runs(c)))))


def mirror_reverse(c: Column) -> Column:
    """Reversed, with bracket pairs swapped; white space at the end stays there."""
    body = rstrip(c)
    return F.concat(F.reverse(F.translate(body, OPENING + MIRRORED, MIRRORED + OPENING)), F.substr(c, F.length(body) + 1))


def is_open(c: Column) -> Column:
    """Whether a fragment may go on in another one."""
    t = rstrip(c)
    return (t != "") & ~F.right(t, F.lit(1)).isin(*FINISHED)


def is_lone_header(c: Column) -> Column:
    """One ``##`` line of at most 100 characters without markup."""
    t = strip(c)
    return F.startswith(t, F.lit("##")) & (F.length(t) < 101) & ~t.contains("\n") & ~t.contains("<div") & ~t.contains("<table") & (F.regexp_count(t, F.lit("##")) == 1)


def format_title(c: Column) -> Column:
    """The first line becomes a second-level heading, with the other lines joined to it by spaces."""
    t = strip(c)
    first = F.element_at(lines(t), 1)
    rest = F.filter(F.transform(F.slice(lines(t), 2, F.greatest(F.size(lines(t)) - 1, F.lit(0))), strip), lambda x: x != "")
    head = F.when(F.startswith(first, F.lit("##")), first).when(F.startswith(first, F.lit("# ")), F.concat(F.lit("#"), first)).otherwise(F.concat(F.lit("## "), first))
    return F.when(F.size(rest) > 0, F.concat_ws(" ", head, F.array_join(rest, " "))).otherwise(head)
