"""Text helpers in two dialects, as SQL over a column reference.

The profiling dialect strips every Unicode whitespace character; the SQL
dialect trims ASCII spaces only.  They give different answers for tabs and
no-break spaces, so each operator says which one it uses.
"""

from __future__ import annotations

from hashlib import sha256

# The characters Python's str.strip() removes, in code point order.
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Text up to this many bytes is a grouping key as it stands; longer text is
# replaced by its digest, so a shuffle never carries whole documents.
KEY_BYTES = 64


def strip(ref: str) -> str:
    """Profiling dialect: remove Unicode whitespace at both ends."""
    return f"btrim({ref}, '{STRIP_CHARS}')"


def tail(ref: str) -> str:
    """The last three bytes, enough to hold any whitespace character."""
    return f"substr(CAST({ref} AS BINARY), -3)"


def padded(ref: str, tail_ref: str) -> str:
    """Profiling dialect: whether there is whitespace at either end.

    Looks at the two ends only, whereas btrim walks the whole text; `tail_ref`
    is the column that holds `tail`.
    """
    leading = ", ".join(str(ord(c)) for c in STRIP_CHARS)
    tests = [f"ascii({ref}) IN ({leading})"]
    for n in (1, 2, 3):
        encoded = [c.encode().hex() for c in STRIP_CHARS if len(c.encode()) == n]
        endings = ", ".join(f"X'{e}'" for e in encoded)
        tests.append(f"substr({tail_ref}, -{n}) IN ({endings})")
    return f"coalesce({' OR '.join(tests)}, false)"


def fold(ref: str) -> str:
    """Profiling dialect: the form under which two spellings are the same value."""
    return f"lower({strip(ref)})"


def sentence_case(ref: str) -> str:
    """SQL dialect: trimmed, first character upper case, the rest lower case."""
    return f"concat(upper(substr(trim({ref}), 1, 1)), lower(substr(trim({ref}), 2)))"


def compact_literal(value: str) -> str:
    """What `compact` makes of a constant."""
    encoded = value.encode()
    return f"sha256:{sha256(encoded).hexdigest()}" if len(encoded) > KEY_BYTES else value


def compact(ref: str) -> str:
    """Bounded-width stand-in for a text value, equal exactly when the text is.

    The digest form is longer than KEY_BYTES, so it never meets a verbatim value.
    """
    return f"if(octet_length({ref}) > {KEY_BYTES}, concat('sha256:', sha2({ref}, 256)), {ref})"
