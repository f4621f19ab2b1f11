"""Values as SQL literals, for expressions written as text.

A long expression made as one text costs one call to the JVM, where the same made of
Column objects costs one per part; for reports of many small expressions that is most
of the time before the first task.
"""

from __future__ import annotations


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_list(values) -> str:
    return ", ".join(text_literal(v) for v in values)
