"""Rule tables turned into CASE expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """One output code with the names that lead to it.

    ``exact`` are whole names, ``prefixes`` name beginnings.  With ``by_text`` the code is decided
    by the first ``(fragment, code)`` pair whose fragment occurs in the description column.
    """

    code: str | None = None
    exact: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()
    by_text: tuple[tuple[str, str], ...] = ()

    def condition(self, name: Column) -> Column:
        test = F.lit(False)
        if self.exact:
            test = name.isin(*self.exact)
        for prefix in self.prefixes:
            test = test | name.startswith(prefix)
        return test

    def result(self, text: Column | None) -> Column:
        if not self.by_text:
            return F.lit(self.code)
        if text is None:
            raise ValueError("a text rule needs a description column")
        chain = None
        for fragment, code in self.by_text:
            chain = (F if chain is None else chain).when(text.contains(fragment), F.lit(code))
        return chain


def classify(name: Column, rules: Sequence[Rule], text: Column | None = None, default=None) -> Column:
    """First rule that matches ``name`` decides; otherwise ``default`` (null unless given)."""
    chain = None
    for rule in rules:
        chain = (F if chain is None else chain).when(rule.condition(name), rule.result(text))
    fallback = default if isinstance(default, Column) else F.lit(default)
    return chain.otherwise(fallback)


def recode(value: Column, mapping: Mapping[str, Sequence[str]]) -> Column:
    """Replace listed values by their group name; every other value stays as it is."""
    return classify(value, [Rule(code, exact=tuple(members)) for code, members in mapping.items()], default=value)


def denied(name: Column, exact: Sequence[str] = (), prefixes: Sequence[str] = ()) -> Column:
    """True for names on the deny list."""
    return F.coalesce(Rule(exact=tuple(exact), prefixes=tuple(prefixes)).condition(name), F.lit(False))


def counter(code: Column, increments: Mapping[str | None, int], default: int = 0) -> Column:
    """Per-row increment chosen by code; the key ``None`` stands for a null code."""
    chain = None
    for key, amount in increments.items():
        test = code.isNull() if key is None else code == F.lit(key)
        chain = (F if chain is None else chain).when(test, F.lit(amount))
    return (chain.otherwise(F.lit(default)) if chain is not None else F.lit(default)).cast("bigint")
