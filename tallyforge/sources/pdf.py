"""The text layer of simple PDF files: an engine for ``readers.read_documents``, with the standard library alone.

It reads files whose pages' contents are plain or deflated streams of text operators with one-byte or two-byte
strings; fonts' own encodings, encrypted files and object streams need another engine. Pages without text are
empty strings, which ``pages.is_scanned`` finds."""

from __future__ import annotations

import re
import zlib

_OBJECT = re.compile(rb"(?s)(\d+)\s+\d+\s+obj\b(.*?)\bendobj")
_STREAM = re.compile(rb"(?s)stream\r?\n(.*?)\r?\nendstream")
_TOKEN = re.compile(rb"(?s)\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|[-+]?\d*\.?\d+|[A-Za-z'\"*]+|/\S+")
_ESCAPE = re.compile(rb"(?s)\\([0-7]{1,3}|\r?\n|.)")
#: Escapes of one letter. Fixed values.
_LETTERS = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
GAP = -200.0  # a step to the right within a line that stands for a space, in thousandths


def _string(token: bytes) -> str:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    else:
        raw = _ESCAPE.sub(lambda m: bytes([int(m[1], 8) & 255]) if m[1][:1].isdigit() else b"" if m[1][-1:] == b"\n" else _LETTERS.get(m[1], m[1]), token[1:-1])
    return raw[2:].decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("latin-1")


def content_text(content: bytes) -> str:
    """The text that a page's operators show, a line for each step downwards."""
    lines, args, parts, height, inside = [""], [], [], None, False
    for token in _TOKEN.findall(content):
        first = token[:1]
        if first == b"[":
            inside, parts = True, []
        elif first == b"]":
            inside = False
        elif first in b"(<":
            (parts if inside else args).append(_string(token))
        elif re.fullmatch(rb"[-+]?\d*\.?\d+", token):
            (parts if inside else args).append(float(token))
        elif first != b"/":
            if token in (b"T*", b"'", b'"') or (token in (b"Td", b"TD") and len(args) >= 2 and args[-1]) or (token == b"Tm" and len(args) >= 6 and height not in (None, args[-1])):
                lines.append("")
            elif token in (b"Td", b"TD") and lines[-1]:
                lines[-1] += "\t"
            if token == b"Tm" and len(args) >= 6:
                height = args[-1]
            if token in (b"Tj", b"'", b'"') and args and isinstance(args[-1], str):
                lines[-1] += args[-1]
            elif token == b"TJ":
                lines[-1] += "".join(x if isinstance(x, str) else " " if x < GAP else "" for x in parts)
            args = []
    return "\n".join(lines).strip("\n")


def page_texts(data: bytes) -> list[str]:
    """A text for each page, in the order of the page tree."""
    if not data.startswith(b"%PDF"):
        raise ValueError("not a PDF file")
    objects = {int(n): body for n, body in _OBJECT.findall(data)}

    def stream(n: int) -> bytes:
        found = _STREAM.search(objects.get(n, b""))
        if not found:
            return b""
        return zlib.decompress(found[1]) if b"FlateDecode" in objects[n][: found.start()] else found[1]

    def pages(n: int, above: tuple[int, ...] = ()) -> list[int]:
        body = objects.get(n, b"")
        kids = re.search(rb"/Kids\s*\[([^\]]*)\]", body)
        if not kids:
            return [n]
        return [p for k in re.findall(rb"(\d+)\s+\d+\s+R", kids[1]) if int(k) not in above for p in pages(int(k), (*above, n))]

    root = next((int(m[1]) for body in objects.values() if re.search(rb"/Type\s*/Catalog", body) and (m := re.search(rb"/Pages\s+(\d+)", body))), None)
    if root is None:
        raise ValueError("no page tree")
    out = []
    for n in pages(root):
        refs = re.search(rb"/Contents\s*(?:\[([^\]]*)\]|(\d+)\s+\d+\s+R)", objects.get(n, b""))
        numbers = [] if not refs else [int(refs[2])] if refs[2] else [int(x) for x in re.findall(rb"(\d+)\s+\d+\s+R", refs[1])]
        out.append(content_text(b"\n".join(map(stream, numbers))))
    return out


def make(pages: list[list[str]], deflate: bool = True) -> bytes:
    """A file with the lines of each page: what ``page_texts`` reads, for tests and fixtures."""
    quote = lambda t: b"(" + re.sub(rb"([\\()])", rb"\\\1", t.encode("latin-1", "replace")) + b")"
    bodies = [b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [" + b" ".join(b"%d 0 R" % (3 + 2 * k) for k in range(len(pages))) + b"] /Count %d >>" % len(pages)]
    for k, lines in enumerate(pages):
        text = b"BT /F1 10 Tf 50 800 Td " + b" 0 -14 Td ".join(quote(t) + b" Tj" for t in lines) + b" ET"
        packed = zlib.compress(text) if deflate else text
        bodies.append(b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (4 + 2 * k))
        bodies.append(b"<< /Length %d%s >>\nstream\n" % (len(packed), b" /Filter /FlateDecode" if deflate else b"") + packed + b"\nendstream")
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (n, body) for n, body in enumerate(bodies, 1)) + b"trailer << /Root 1 0 R >>\n%%EOF"
