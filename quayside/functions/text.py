"""Standardising codes and free text."""

from __future__ import annotations

# Accepted spellings of each voucher type, compared in lower case.
VOUCHER_SPELLINGS = {
    "Original": ("original",),
    "Supplementary": ("supplementary",),
    "Credit Note": ("credit note", "creditnote", "cn"),
}


def literal(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def code(c: str) -> str:
    """A natural key: surrounding spaces removed, upper case."""
    return f"upper(trim({c}))"


def voucher_type(c: str) -> str:
    """One spelling per voucher type; unknown types pass through trimmed."""
    arms = " ".join(
        f"when lower(trim({c})) in ({', '.join(map(literal, spellings))}) then {literal(name)}"
        for name, spellings in VOUCHER_SPELLINGS.items()
    )
    return f"case {arms} else trim({c}) end"


def credited_invoice(narration: str) -> str:
    """Invoice number named at the end of a credit-note narration; '' when none is named.

    `(?d)` and `\\z` keep a trailing line break from being skipped, so the target is the
    rest of the text or nothing.
    """
    return f"regexp_extract({narration}, r'(?d)against (.+)\\z', 1)"


def lane_label(origin_name: str, destination_name: str) -> str:
    """Short `origin → destination` label from two full port names."""
    origin = f"substring_index(substring_index({origin_name}, ' — ', 1), ' (', 1)"
    dest = f"substring_index(substring_index({destination_name}, ' Port', 1), ' International', 1)"
    return f"concat({origin}, ' → ', replace({dest}, 'Port of ', ''))"
