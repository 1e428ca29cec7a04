"""Reading and writing the block subset of YAML in which article files keep their fields."""

from __future__ import annotations

from typing import Any

from pyspark.sql import types as T


class Malformed(ValueError):
    pass


def split_document(content: str) -> tuple[str, str]:
    """Front matter and body of a file that starts with a line of three dashes."""
    if not content.startswith("---\n"):
        raise Malformed("no front matter")
    end = content.find("\n---\n", 3)
    if end < 0:
        raise Malformed("front matter does not end")
    return content[4 : end + 1], content[end + 5 :]


def scalar(text: str) -> Any:
    """A scalar as text; null for nothing, empty containers for [] and {}."""
    text = text.strip()
    if text in ("", "~", "null"):
        return None
    if text == "[]":
        return []
    if text == "{}":
        return {}
    if text[0] == "'":
        if len(text) < 2 or text[-1] != "'":
            raise Malformed(f"quote does not end: {text[:40]}")
        return text[1:-1].replace("''", "'")
    if text[0] == '"':
        if len(text) < 2 or text[-1] != '"':
            raise Malformed(f"quote does not end: {text[:40]}")
        return text[1:-1].replace('\\"', '"').replace("\\n", "\n").replace("\\\\", "\\")
    return text


def parse(text: str) -> dict[str, Any]:
    """Mappings, lists and scalars by indentation; all scalars stay text."""
    rows = [(len(x) - len(x.lstrip(" ")), x.strip()) for x in text.split("\n") if x.strip() and not x.lstrip().startswith("#")]
    value, at = _block(rows, 0, 0)
    if at < len(rows) or not isinstance(value, dict):
        raise Malformed(f"unexpected line: {rows[at][1][:40]}" if at < len(rows) else "no mapping")
    return value


def _block(rows: list[tuple[int, str]], at: int, indent: int) -> tuple[Any, int]:
    if at >= len(rows):
        return {}, at
    return _list(rows, at, rows[at][0]) if rows[at][1].startswith("- ") or rows[at][1] == "-" else _mapping(rows, at, indent)


def _mapping(rows: list[tuple[int, str]], at: int, indent: int) -> tuple[dict, int]:
    out: dict[str, Any] = {}
    while at < len(rows) and rows[at][0] == indent and not rows[at][1].startswith("- "):
        key, colon, rest = rows[at][1].partition(":")
        if not colon or rest and rest[0] != " ":
            raise Malformed(f"no key: {rows[at][1][:40]}")
        key = str(scalar(key))
        if key in out:
            raise Malformed(f"key twice: {key}")
        at += 1
        if rest.strip():
            out[key] = scalar(rest)
        elif at < len(rows) and (rows[at][0] > indent or rows[at][0] == indent and rows[at][1].startswith("- ")):
            out[key], at = _block(rows, at, rows[at][0])
        else:
            out[key] = None
    return out, at


def _list(rows: list[tuple[int, str]], at: int, indent: int) -> tuple[list, int]:
    out: list[Any] = []
    while at < len(rows) and rows[at][0] == indent and rows[at][1].startswith("- "):
        item = rows[at][1][2:].strip()
        key, colon, rest = item.partition(":")
        if colon and (not rest or rest[0] == " ") and item[0] not in "'\"":
            # A mapping that starts on the dash's line goes on two columns further in.
            rows[at] = (indent + 2, item)
            value, at = _mapping(rows, at, indent + 2)
            out.append(value)
        else:
            out.append(scalar(item))
            at += 1
    return out, at


def conform(value: Any, kind: T.DataType) -> Any:
    """A parsed value in a schema's type; keys that the schema lacks are left out."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        if not isinstance(value, dict):
            raise Malformed("a mapping is wanted")
        return {f.name: conform(value.get(f.name), f.dataType) for f in kind.fields}
    if isinstance(kind, T.ArrayType):
        if not isinstance(value, list):
            raise Malformed("a list is wanted")
        return [conform(x, kind.elementType) for x in value]
    if isinstance(value, (list, dict)):
        raise Malformed("a scalar is wanted")
    if isinstance(kind, T.IntegerType):
        try:
            return int(value)
        except ValueError as e:
            raise Malformed(f"no whole number: {value[:40]}") from e
    if isinstance(kind, T.BooleanType):
        if value not in ("true", "false"):
            raise Malformed(f"neither true nor false: {value[:40]}")
        return value == "true"
    return value


def dump(fields: dict[str, Any], indent: int = 0) -> str:
    """The fields as block YAML in their order; nulls are left out."""
    pad, out = " " * indent, []
    for key, value in fields.items():
        if value is None:
            continue
        if isinstance(value, dict):
            out.append(f"{pad}{key}:\n{dump(value, indent + 2)}")
        elif isinstance(value, (list, tuple)):
            out.append(f"{pad}{key}: []\n" if not len(value) else f"{pad}{key}:\n")
            for item in value:
                if isinstance(item, dict):
                    body = dump(item, indent + 2)
                    out.append(f"{pad}- {body[indent + 2:]}")
                else:
                    out.append(f"{pad}- {quoted(item)}\n")
        else:
            out.append(f"{pad}{key}: {quoted(value)}\n")
    return "".join(out)


def quoted(value: Any) -> str:
    """A scalar as it must be written to be read back as the same text."""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return str(value)
    text = str(value)
    digits = text.replace("-", "").isdigit() and (text.isdigit() or len(text) == 10)
    if not text or digits or text in ("true", "false", "null", "~", "[]", "{}") or text != text.strip() or text[0] in "'\"#-[]{}&*!|>%@`" or ": " in text or text.endswith(":") or " #" in text:
        return "'" + text.replace("'", "''") + "'"
    return text
