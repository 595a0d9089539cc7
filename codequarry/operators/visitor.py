"""Per-file helper: facts of one Python source text, as plain rows.

It only reads positions off the standard parser. Ids, redaction, relations and
the choice among repeats are DataFrame expressions elsewhere.
"""

from __future__ import annotations

import ast
import io
import re
import tokenize
from itertools import accumulate

from codequarry.operators.recovery import UNREADABLE, pieces

_LINE_END = re.compile(rb"\r\n|\r|\n")
# A parameter list without strings, comments or nested brackets.
_PLAIN_PARAMETERS = re.compile(r"\s*(\([^()\[\]{}'\"#]*\))")
# Comments, strings without a prefix that nests code, and brackets of a heading in plain characters.
_PLAIN_HEADING = re.compile(r"[\t\n\x20-\x7e]*")
_HEADING_TOKENS = re.compile(
    r"""#[^\n]*|(?P<prefix>\b[A-Za-z]{1,2})?(?:\"\"\"(?:[^"\\]|\\.|"(?!""))*\"\"\"|\'\'\'(?:[^'\\]|\\.|'(?!''))*\'\'\'"""
    r"""|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|[()\[\]{}"']""",
    re.DOTALL,
)
_BYTE_ORDER_MARK = chr(0xFEFF)
# One string literal without a prefix that changes its quotes' meaning.
_ONE_LITERAL = re.compile(
    r"""[rRbBuU]{0,2}(?:\"\"\"(?:[^"\\]|\\.|"(?!""))*\"\"\"|\'\'\'(?:[^'\\]|\\.|'(?!''))*\'\'\'"""
    r"""|"(?!"")(?:[^"\\\n]|\\.)*"|'(?!'')(?:[^'\\\n]|\\.)*')""",
    re.DOTALL,
)


class _Source:
    """Source with line starts, to cut out the text of a node: bytes, or the text itself where all of it is ASCII."""

    def __init__(self, text: str):
        self.raw = text if text.isascii() else text.encode("utf-8", "replace")
        end, turn = ("\n", "\r") if self.raw is text else (b"\n", b"\r")
        if turn in self.raw:
            raw = self.raw.encode() if self.raw is text else self.raw
            self.starts = [0, *(m.end() for m in _LINE_END.finditer(raw))]
        else:
            self.starts = list(accumulate(map(len, self.raw.split(end)), lambda at, size: at + size + 1, initial=0))

    def text(self) -> str:
        return self.cut(0, len(self.raw))

    def at(self, line: int, column: int) -> int:
        return self.starts[line - 1] + column

    def cut(self, start: int, end: int) -> str:
        piece = self.raw[start:end]
        return piece if isinstance(piece, str) else piece.decode("utf-8", "replace")

    def of(self, node) -> str:
        return self.cut(
            self.at(node.lineno, node.col_offset), self.at(node.end_lineno, node.end_col_offset)
        )


def _parameters(heading: str, name: str) -> str:
    """Bracketed parameter text of a function heading (from ``def`` to the body)."""
    after = heading.index(name, heading.index("def") + 3) + len(name)
    plain = _PLAIN_PARAMETERS.match(heading, after)
    if plain:
        return plain.group(1)
    found = _scanned_parameters(heading, after) if _PLAIN_HEADING.fullmatch(heading) else None
    if found is not None:
        return found
    lines = heading.splitlines(keepends=True)
    depth, opened, seen_name = 0, None, False
    for token in tokenize.generate_tokens(io.StringIO(heading).readline):
        if not seen_name:
            seen_name = token.type == tokenize.NAME and token.string == name
        elif token.type == tokenize.OP and token.string in "([{":
            if depth == 0 and token.string == "(":
                opened = token.start
            depth += 1
        elif token.type == tokenize.OP and token.string in ")]}":
            depth -= 1
            if depth == 0 and opened is not None:
                return _between(lines, opened, token.end)
    return ""


def _scanned_parameters(heading: str, after: int) -> str | None:
    """The first outer brackets behind ``after``; None where the tokenizer has to decide."""
    depth, opened = 0, None
    for token in _HEADING_TOKENS.finditer(heading, after):
        text = token.group()
        if text in ("(", "[", "{"):
            if depth == 0 and text == "(":
                opened = token.start()
            depth += 1
        elif text in (")", "]", "}"):
            depth -= 1
            if depth == 0 and opened is not None:
                return heading[opened : token.end()]
        elif text in ("'", '"') or (token["prefix"] or "r").lower() not in ("r", "b", "u", "rb", "br"):
            return None
    return None


def _between(lines: list[str], start: tuple[int, int], end: tuple[int, int]) -> str:
    (first, left), (last, right) = start, end
    if first == last:
        return lines[first - 1][left:right]
    middle = lines[first : last - 1]
    return "".join([lines[first - 1][left:], *middle, lines[last - 1][:right]])


def _signature(source: _Source, node) -> str:
    start = source.at(node.lineno, node.col_offset)
    body = node.body[0]
    decorators = getattr(body, "decorator_list", ())
    first_line = min(body.lineno, *(d.lineno for d in decorators)) if decorators else body.lineno
    end = source.at(first_line, body.col_offset if first_line == body.lineno else 0)
    heading = source.cut(start, end)
    try:
        return node.name + _parameters(heading, node.name)
    except (tokenize.TokenError, SyntaxError, ValueError):
        return node.name


def _docstring(source: _Source, node) -> str | None:
    """Literal text, quotes included, of a leading string statement."""
    first = node.body[0]
    if not isinstance(first, ast.Expr) or not isinstance(first.value, (ast.Constant, ast.JoinedStr)):
        return None
    value = first.value
    if isinstance(value, ast.Constant) and not isinstance(value.value, (str, bytes)):
        return None
    if (first.lineno, first.col_offset) != (value.lineno, value.col_offset):
        return None  # in brackets
    text = source.of(value)
    if _ONE_LITERAL.fullmatch(text):
        return text
    # Adjacent literals are one value to the parser but not one string here.
    strings = [t for t in _tokens(text) if t in ("string", "fstring")]
    return text if len(strings) == 1 else None


def _tokens(text: str):
    """Kinds of the string literals at the top of an expression text."""
    fstring_start = getattr(tokenize, "FSTRING_START", -1)
    fstring_end = getattr(tokenize, "FSTRING_END", -1)
    depth = 0
    for token in tokenize.generate_tokens(io.StringIO(text).readline):
        if token.type == fstring_start:
            depth += 1
            if depth == 1:
                yield "fstring"
        elif token.type == fstring_end:
            depth -= 1
        elif token.type == tokenize.STRING and depth == 0:
            yield "string"


# Statements that hold no others.
_LEAVES = frozenset((
    ast.Expr, ast.Assign, ast.AnnAssign, ast.AugAssign, ast.Return, ast.Pass, ast.Raise, ast.Assert, ast.Delete,
    ast.Global, ast.Nonlocal, ast.Break, ast.Continue,
))


# Statements with one block.
_BODY_ONLY = frozenset((ast.Module, ast.ClassDef))


def _statements(node):
    """Child statements in source order, through any block."""
    return node.body if type(node) in _BODY_ONLY else _nested(node)


def _nested(node):
    for field in ("body", "handlers", "orelse", "finalbody", "cases"):
        value = getattr(node, field, None)
        if isinstance(value, list):
            yield from value


def python_facts(text: str):
    """Facts of one file: the module first, then statements in walk order.

    Of a file with errors, all that can be read around them, and an ``Error`` fact for
    the lines of each that cannot.
    """
    yield {
        "kind": "Module", "name": None, "owner": None,
        "line_start": 1, "line_end": text.count("\n") + 1,
        "content": text,
    }
    # A byte order mark is text to the line and character counts above only.
    source = _Source(text.removeprefix(_BYTE_ORDER_MARK))
    readable = source.text()
    try:
        found = _walk(source, ast.parse(readable), None, [])
    except UNREADABLE as error:
        found = _recovered(readable, error)
    yield from found


def _recovered(text: str, failed: Exception | None, before: int = 0):
    for piece in pieces(text, failed):
        errors = piece.errors
        if piece.tree is not None:
            try:
                found = _walk(_Source(piece.text), piece.tree, None, []) if piece.tree.body else []
            except UNREADABLE as error:
                if piece.several:
                    yield from _recovered(piece.text, None, before)
                    continue
                found, lines = [], piece.text.count("\n") + 1
                errors = [(piece.lines_before + 1, piece.lines_before + lines, type(error).__name__)]
            for fact in found:
                fact["line_start"] += before + piece.lines_before
                fact["line_end"] += before + piece.lines_before
                yield fact
        for first, last, reason in errors:
            yield {"kind": "Error", "line_start": before + first, "line_end": before + last, "parse_error": reason}


def _walk(source: _Source, node, owner: str | None, out: list[dict]) -> list[dict]:
    for child in _statements(node):
        kind = type(child)
        if kind in _LEAVES:
            continue
        if kind is ast.ImportFrom and child.module == "__future__":
            continue
        if kind is ast.Import or kind is ast.ImportFrom:
            text = source.of(child)
            out.append(_fact("Import", text, None, child, content=text))
        elif kind is ast.ClassDef:
            out.append(_fact(
                "Class", child.name, None, child,
                docstring=_docstring(source, child),
                content=source.of(child),
                bases=[b.id for b in child.bases if isinstance(b, ast.Name)],
            ))
            _walk(source, child, child.name, out)
        elif kind is ast.FunctionDef or kind is ast.AsyncFunctionDef:
            out.append(_fact(
                "Function" if owner is None else "Method", child.name, owner, child,
                signature=_signature(source, child),
                docstring=_docstring(source, child),
                content=source.of(child),
            ))
        else:
            _walk(source, child, owner, out)
    return out


def _fact(kind: str, name: str, owner: str | None, node, **more) -> dict:
    return {
        "kind": kind, "name": name, "owner": owner,
        "line_start": node.lineno, "line_end": node.end_lineno, **more,
    }
