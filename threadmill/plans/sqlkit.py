"""DuckDB SQL fragments mirroring the Spark expressions (oracle side only)."""

from __future__ import annotations

from .. import config as C

# Same whitespace set as config.STRIP_CHARS, in RE2 syntax.
WS = r"[\t-\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
TOKEN_RE = r"[^\p{L}\p{N}]+"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def clean(x: str) -> str:
    return strip(f"replace(coalesce({x}, ''), chr(13) || chr(10), chr(10))")


def ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def path_part(x: str) -> str:
    """One position of a printable path: six digits, or '~' for each digit beyond six and all digits."""
    t = f"CAST({x} AS VARCHAR)"
    return f"CASE WHEN length({t}) <= 6 THEN lpad({t}, 6, '0') ELSE repeat('~', length({t}) - 6) || {t} END"


def tokens_unnest(text: str) -> str:
    """Use as: FROM t, unnest(<this>) AS u(tok) WHERE tok <> ''."""
    return f"regexp_split_to_array(lower({text}), '{TOKEN_RE}')"


def bucket(tok: str, dims: int = C.HASH_DIMS) -> str:
    return f"CAST(('0x' || substr(md5({tok}), 1, 7)) AS BIGINT) % {dims}"


def fmt_template(template: str, names: list[str]) -> str:
    """Template with {name} placeholders -> DuckDB format() string ({0}, {1}, ...)."""
    out = template
    for i, n in enumerate(names):
        out = out.replace("{" + n + "}", "\u0000" + str(i) + "\u0001")
    out = out.replace("{", "{{").replace("}", "}}")
    out = out.replace("\u0000", "{").replace("\u0001", "}")
    return lit(out)
