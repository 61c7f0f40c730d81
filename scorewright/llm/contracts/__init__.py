"""The queries of the dealt operators over their whole tables, with their SQL where SQL can say it."""

from scorewright.llm.contracts import coded, native, pairs, rows, spans  # noqa: F401
