"""Column expressions for text: line splitting and the term tokenizer.

Everything here returns a Column built from Catalyst built-ins, so it runs
inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The term delimiter characters of the tokenizer (space, * $ & # /,
# tab, newline, form feed, double quote, single quote, backslash, , . : ; ? !
# [ ] ( ) { } < > ~ - _).  Everything else, digits and @ % + = | ^ ` included,
# belongs to a term.
TERM_DELIMITERS = " *$&#/\t\n\f\"'\\,.:;?![](){}<>~-_"

# Fixed value: a line ends at CR LF, CR or LF.
LINE_BREAK = r"\r\n|\r|\n"

_CONTROL_ESCAPES = {"\t": r"\t", "\n": r"\n", "\f": r"\f", "\r": r"\r"}


def _char_class(chars: str) -> str:
    """A regex character class matching any of ``chars`` (Java and RE2 syntax)."""
    body = "".join(
        _CONTROL_ESCAPES.get(c) or (c if c.isalnum() else "\\" + c) for c in chars)
    return "[" + body + "]"


# One or more delimiters.  A carriage return also separates terms: the line
# reader of the original jobs consumes it, so treating it as a delimiter gives
# the same terms as splitting into lines first.
TERM_SPLIT_REGEX = _char_class(TERM_DELIMITERS + "\r") + "+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text: Column | str) -> Column:
    """Lower-cased terms of ``text`` in order, repeats kept, no empty terms.

    ``array<string>``; NULL text gives NULL.
    """
    parts = F.split(F.lower(_col(text)), TERM_SPLIT_REGEX)
    return F.array_remove(parts, "")


def split_lines(text: Column | str) -> Column:
    """The lines of ``text`` as ``array<string>`` (CR LF, CR and LF end a line)."""
    return F.split(_col(text), LINE_BREAK)
