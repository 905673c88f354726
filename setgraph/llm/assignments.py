"""Reads the assignments of source and configuration syntax out of a text.

A lexer gives names, strings, bare values, operators, brackets and line ends.  A
stack of open brackets says which targets a value belongs to: an operator after a
name opens a target, a literal goes to the open targets of the innermost bracket
that has some, a comma, a semicolon or the end of the line closes them.  One pass, no look back, so
the time is linear in the text.

Names come from: ``name = x`` (``:=``, ``+=``, ``?=``, ``=>``, ``:``, also with a type between), subscripts
(``c['name'] = x``), unpacking (``a, b = x, y``), options (``--name x``), ``#define NAME x``,
``ENV NAME x``, calls whose first argument is a string (``setenv("NAME", x)``), ``IDENTIFIED BY x`` and
``WITH PASSWORD x`` (target ``password``), elements (``<name>x</name>``), the pair of a ``name`` or ``key`` and a
``value``; in nested YAML and JSON also from the keys around a key.

Strings: single and double quotes with escapes, on one line; three quotes, over
lines; backticks as a value; prefixes such as ``b`` ``r`` ``f`` ``@``.  A quote without an end in its
line, or inside a word, is no string, nor are later ones of its kind in that line.
An empty line closes every bracket.  Arguments of calls that only look something up
(``getenv("X")``) are no literals of the target.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

_TOKEN = re.compile(
    r"""[ \t\r\f\v\\]*(?:(?P<line>\n)|(?P<name>--(?=[A-Za-z])[A-Za-z][\w\-]*|[$%&*@#]?[A-Za-z_](?:\w|[.\-](?=\w))*|\$\{\w+\})"""
    r"""|(?P<quote>["'`])|(?P<op>:=|\?\?=|\|\|=|[+?.]=(?![=>])|=>|->|::|[=!<>]=+|=~|</|=|:)|(?P<other>\d+(?:\w|[.\-](?=\w))*|.)|$)""", re.A | re.S)
_ASSIGNS = {":=", "??=", "||=", "+=", "?=", ".=", "=>", "=", ":"}
_BODY = {'"': re.compile(r'(?:[^"\\\n]|\\.)*', re.S), "'": re.compile(r"(?:[^'\\\n]|\\.)*", re.S), "`": re.compile(r"(?:[^`\\\n]|\\.)*", re.S)}
_BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>+]+(?:\+[^\s"'`,;(){}\[\]<>+]+)*""")
_BLANKS = re.compile(r"[ \t]*")
_KEY = re.compile(r"[ \t]*(?::(?![:=])|=>)")
_GOES_ON = re.compile(r"[(\[]|[ \t]*(?:\+|\|\||\?|=(?![=>])|or\b)|[ \t]+(?:if|as)\b")
_NAMELIKE = re.compile(r"[A-Za-z_][\w.\-]*\Z", re.A)
_PREFIX = re.compile(r"(?:[bBrRuUfFNL]|[bBfF][rR]|[rR][bBfF]|u8)\Z")
_ELEMENT = re.compile(r"[^<>\s]+(?=</)")
_LIFETIME = re.compile(r"&'\w+[ \t]+")
_FIRST = re.compile(r"[A-Za-z_]?[^:=]*")
_TAG = re.compile(r"[A-Za-z_][\w.\-]*", re.A)
_INDENT = re.compile(r"[ \t]*(?:-[ \t]+)?")
_LOOKS_UP = re.compile(r"(?i)(?:^|[._])(?:get|env|environ|lookup|fetch|read|load|input|prompt|find|open)[^.]*\Z")
_CLOSES = {")": "(", "]": "[", "}": "{", ">": "<"}
#: Names of a pair's first and second half.
_LABEL, _VALUE = {"name", "key"}, {"value", "content"}
#: Type words, which are no constants of the text.
TYPES = {"str", "string", "bytes", "text", "char", "any", "object", "none", "null", "undefined"}
#: After these words, the first of a line, a name and its value follow without an operator.
_COMMANDS = {"#define", "ENV", "setx", "setenv"}


@dataclass
class Assignment:
    """A target, the key around it, the spans of its literals and the earlier assignments it refers to."""

    name: str
    around: int | None = None
    literals: list[tuple[int, int]] = field(default_factory=list)
    refers: list[int] = field(default_factory=list)


@dataclass
class _Frame:
    """An open bracket: what its values belong to, and the targets open inside it."""

    bracket: str
    outer: list[int]                # targets of the expression that the bracket stands in
    around: int | None = None       # the key whose value the bracket is
    call: bool = False
    targets: list[int] = field(default_factory=list)
    place: int | None = None        # which target the next value is for, when several are unpacked
    names: list[str] = field(default_factory=list)   # target list read so far
    words: list[str] = field(default_factory=list)   # names that follow each other by blanks
    comma: bool = False


class _Reader:
    def __init__(self, text: str):
        self.text = text
        self.out: list[Assignment] = []
        self.known: dict[str, int] = {}
        self.stack = [_Frame("", [])]
        self.parents: list[tuple[int, int]] = []   # indent and number of the YAML keys around
        self.label = ""
        self.no_end: dict[str, int] = {}                # quote -> place up to which it has no end

    def string(self, at: int, quote: str) -> tuple[int, int, int] | None:
        """(start, end, place after) of the string whose quote is at ``at``."""
        if self.no_end.get(quote, -1) >= at:
            return None
        if quote != "`" and self.text.startswith(quote * 3, at):
            end = self.text.find(quote * 3, at + 3) if self.no_end.get(quote * 3, -1) < at else -1
            if end >= 0:
                return at + 3, end, end + 3
            self.no_end[quote * 3] = len(self.text)
        body = _BODY[quote].match(self.text, at + 1)
        if self.text.startswith(quote, body.end()):
            return at + 1, body.end(), body.end() + 1
        self.no_end[quote] = body.end()
        return None

    def open(self, names: list[str], joins: bool = False) -> None:
        """New targets.  ``joins``: of the value whose target is open, as in ``a = b = x``; the
        literals stay that one's, and the new ones refer to it."""
        top, new = self.stack[-1], []
        for name in names:
            if name.lower() not in TYPES:
                self.known[name] = len(self.out)
            new.append(len(self.out))
            self.out.append(Assignment(name, top.around, refers=[top.targets[0]] if joins else []))
        if not joins:
            top.targets, top.place = new, 0 if len(new) > 1 else None

    def owners(self) -> list[int]:
        top = self.stack[-1]
        if top.targets:
            return top.targets if top.place is None else top.targets[top.place:top.place + 1]
        return top.outer

    def literal(self, a: int, b: int) -> None:
        top = self.stack[-1]
        half = self.out[top.targets[-1]].name.lower() if top.targets else ""
        if half in _VALUE and self.label:
            self.open([self.label], joins=True)
            self.label = ""
        elif half in _LABEL:
            self.label = self.text[a:b] if b - a < 200 and _NAMELIKE.match(self.text[a:b]) else ""
        for k in self.owners():
            self.out[k].literals.append((a, b))

    def refer(self, name: str) -> None:
        if name in self.known:
            for k in self.owners():
                if self.known[name] != k:
                    self.out[k].refers.append(self.known[name])

    def named(self, name: str) -> None:
        """``name`` may be a target: one more of a list after a comma, else the only one."""
        top = self.stack[-1]
        if top.comma and name:
            top.names.append(name)
        else:
            top.names = [name] if name else []
        top.comma = False

    def value(self, at: int) -> int:
        """Reads what begins right after an operator if it is a bare value; the place after it."""
        at = _BLANKS.match(self.text, at).end()
        if self.text[at:at + 1] in "&*" and self.text[at + 1:at + 2] in "'\"":   # a reference's lifetime
            word = _LIFETIME.match(self.text, at)
            return word.end() if word else at
        bare = _BARE.match(self.text, at)
        if not bare:
            return at
        word = bare[0]
        if self.text.startswith(("@'", '@"', "$'", '$"'), at) or (_PREFIX.match(bare[0]) and self.text[bare.end():bare.end() + 1] in "\"'" and bare.end() < len(self.text)):
            return at
        if word in self.known or word[0] == "$":
            return at
        if bare[0][-1] in ":=" or _GOES_ON.match(self.text, bare.end()):
            return at   # an expression or a further target begins
        self.literal(*bare.span())
        return bare.end() if "://" in bare[0] else at + len(_FIRST.match(bare[0])[0])

    def end_targets(self) -> None:
        top = self.stack[-1]
        if top.place == 0:   # one value for several names is the last one's too
            self.out[top.targets[-1]].refers.append(top.targets[0])
        top.targets, top.place, top.names, top.words, top.comma = [], None, [], [], False

    def read(self) -> list[Assignment]:
        text, at, line, start = self.text, 0, 0, True   # start: no token yet in this line
        last, first_word = "", ""
        while at < len(text):
            m = _TOKEN.match(text, at)
            kind = m.lastgroup
            if kind is None:
                break
            i, at, top = m.start(kind), m.end(), self.stack[-1]
            token = m[kind]
            if kind == "line":
                if start and len(self.stack) > 1:
                    self.stack = self.stack[:1]
                    top = self.stack[-1]
                while self.stack[-1].bracket == "<":
                    self.stack.pop()
                if len(self.stack) == 1 and not (last in _ASSIGNS and last != ":" or last == "+" or text[:m.start()][-1:] == "\\" or text[m.start():i].endswith("\\")):
                    self.end_targets()
                elif self.stack[-1].bracket == "{":
                    self.end_targets()
                line, start, last, first_word = at, True, last if last in _ASSIGNS else "\n", ""
                continue
            indent = i - line
            if kind == "quote":
                inside = i > 0 and text[i - 1].isalnum() and last != "prefix"
                found = None if inside or (token == "`" and not (top.targets or top.outer)) else self.string(i, token)
                if found:
                    a, b, at = found
                    name = text[a:b] if b - a < 200 and _NAMELIKE.match(text[a:b]) else ""
                    key = bool(_KEY.match(text, at)) and last != "?" and (start or last in ("{", ",", "\n", "[", "(") or not top.targets)
                    first = top.call and last == "("
                    if key:
                        self.end_targets()
                    elif [w.upper() for w in top.words[-2:]] in (["IDENTIFIED", "BY"], ["WITH", "PASSWORD"], ["ENCRYPTED", "PASSWORD"]):
                        self.open(["password"])
                        self.literal(a, b)
                        self.end_targets()
                    else:
                        self.literal(a, b)
                    self.named(name)
                    top.words = []
                    if first and name and text.startswith(",", _BLANKS.match(text, at).end()):
                        last, start = "argument", False
                        continue
                    last, start = "string", False
                    # an attribute's target ends with its value
                    if top.targets and text[i - 1:i] == "=" and text[at:at + 1] in (" ", "/", ">") and self.in_tag:
                        top.targets = []
                    continue
                last, start = token, False
            elif kind == "name":
                if _PREFIX.match(token) and text[at:at + 1] in ("'", '"') or token in "@$":
                    last, start = "prefix", False
                    continue
                name = token.lstrip("$%&*@-") if token[0] in "$%&*@-" else token
                name = name.strip("{}")
                if start:
                    first_word = token
                    if len(self.stack) == 1:
                        while self.parents and self.parents[-1][0] >= indent + (last == "-"):
                            self.parents.pop()
                        top.around = self.parents[-1][1] if self.parents else None
                if top.place is not None and last in ("string", "value", "name"):   # prose goes on, not the list of values
                    self.end_targets()
                self.refer(name)
                top.words = [*top.words[-2:], name] if last in ("name", "command") else [name]
                self.named(name)
                nxt = _BLANKS.match(text, at).end()
                follows = text[nxt:nxt + 1]
                if token.startswith("--") and follows not in ("", "\n", "=") and nxt > at and follows != "-":
                    self.open([name])
                    at = self.value(at)
                elif first_word in _COMMANDS and last == "command" and follows not in ("", "\n", "=", "("):
                    self.open([name])
                    at = self.value(at)
                elif follows == "<" and top.targets and text[nxt + 1:nxt + 2].isalpha():
                    self.stack.append(_Frame("<", []))
                    at = nxt + 1
                last = "command" if start and token in _COMMANDS else "name"
                start = False
            elif kind == "op":
                if token == "</":
                    self.in_tag = False
                    self.end_targets()
                elif token in _ASSIGNS and (top.bracket == "<" or top.names or top.targets):
                    if top.bracket == "<":
                        self.stack.pop()
                        top = self.stack[-1]
                        if top.targets:
                            at, last, start = self.value(at), token, False
                            continue
                    names = top.names[-1:] if top.call else top.names   # f(x, name=y) unpacks nothing
                    if len(top.words) == 3 and top.words[0] in ("var", "const"):
                        self.open([top.words[1]])   # "var name type =" or "const type name ="
                        self.open([top.words[2]], joins=True)
                    elif top.names:
                        joins = bool(top.targets) and last in ("name", "string", "]", ">") and token != "=>" and top.place is None
                        self.open(names, joins)
                    top.names, top.words, top.comma = [], [], False
                    here = _BLANKS.match(text, at).end()
                    if token == ":" and len(self.stack) == 1 and text[here:here + 1] in ("\n", "\r") and top.targets:
                        k = top.targets[-1]
                        self.parents.append((self.indent_of(line), k))
                    elif text[here:here + 1] != "#" or token != ":":
                        at = self.value(at)
                        token = token if at == here else "value"
                last, start = token, False
            else:
                if token == "," or token == ";":
                    while self.stack[-1].bracket == "<" and token == ";":
                        self.stack.pop()
                    top = self.stack[-1]
                    if last == "argument" and token == ",":   # f("NAME", x)
                        self.open([top.names[-1]])
                        at, last = self.value(at), ","
                        continue
                    if top.place is not None and token == "," and last in ("string", "value", "name", "]", ")", "}"):
                        top.place += 1
                        here = _BLANKS.match(text, at).end()
                        at = self.value(at)
                        last = "value" if at > here else ","
                        continue
                    elif token == "," and top.names and not top.targets and last in ("name", "string"):
                        top.comma = True
                    else:
                        self.end_targets()
                elif token in "([{":
                    own = self.owners()
                    call = token == "(" and last in ("name", "command")
                    outer = [] if call and _LOOKS_UP.search(top.words[-1] if top.words else "") else list(own)
                    around = top.around if token != "{" else own[-1] if own else None
                    self.stack.append(_Frame(token, outer, around, call))
                elif token in ")]}>":
                    if len(self.stack) > 1 and self.stack[-1].bracket == _CLOSES[token]:
                        gone = self.stack.pop()
                        if token in "]}" and gone.names and last in ("string", "name") and not gone.targets and not self.stack[-1].targets:
                            self.stack[-1].names, self.stack[-1].words = gone.names[-1:], []   # c['name'] =
                            last, start = "name", False
                            continue
                    if token == ">":
                        element = _ELEMENT.match(text, at) if self.in_tag and self.tag else None
                        if element:
                            self.open([self.tag])
                            self.literal(*element.span())
                            at = element.end()
                            self.end_targets()
                        self.in_tag = False
                elif token == "<":
                    tag = _TAG.match(text, at)
                    self.in_tag, self.tag = bool(tag), tag[0] if tag else ""
                    if tag:
                        self.end_targets()
                        at = tag.end()
                elif token == "-" and start and len(self.stack) == 1 and text[at:at + 1] == " ":   # an item of a YAML list
                    while self.parents and self.parents[-1][0] > indent:
                        self.parents.pop()
                    if self.parents:
                        top.around, top.targets, top.place = self.parents[-1][1], [self.parents[-1][1]], None
                        here = at
                        at = self.value(at)
                        if at == here or text[at:at + 1] == ":":
                            at = here
                        last = "-"
                        continue
                elif token == "&" or token == "*":
                    continue
                last, start = token, False
        while self.stack:
            self.end_targets()
            self.stack.pop()
        return self.out

    in_tag, tag = False, ""

    def indent_of(self, line: int) -> int:
        return _INDENT.match(self.text, line).end() - line


def assignments(text: str) -> list[Assignment]:
    """The assignments in the order of the text; a nested key has the number of the key
    around it.  A name in an expression refers to the last
    assignment to it before.  In ``name: type = literal`` the literal is the name's and,
    as it may be a label before an assignment, the type word's too."""
    return _Reader(text).read()
