"""Column roles of a regression frame.

The source job spelled its roles out as hard-coded lists (label, numeric features,
categoricals, a 0/1 flag, ignored columns, a dependent column). ``FeatureSpec``
holds the same information so every operator works on any schema.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Ratio:
    """A derived feature ``name = numerator / denominator`` (NULL when the divisor is 0)."""

    name: str
    numerator: str
    denominator: str


@dataclass(frozen=True)
class FeatureSpec:
    label: str = "label"
    key: str | None = None
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    binary: tuple[str, ...] = ()
    ratios: tuple[Ratio, ...] = ()
    ignored: tuple[str, ...] = ()
    # Columns that leak the label (known only with it); never model inputs.
    dependent: tuple[str, ...] = ()
    # Columns whose correlations are shown, but that are never model inputs.
    explored: tuple[str, ...] = ()
    # Features kept whatever the correlation rules say (analyst's judgement).
    keep: tuple[str, ...] = field(default=())

    @property
    def ratio_names(self) -> tuple[str, ...]:
        return tuple(r.name for r in self.ratios)

    def correlation_candidates(self) -> tuple[str, ...]:
        """Numeric columns, derived ratios and explored columns included, that correlation may screen."""
        return tuple(c for c in self.numeric + self.ratio_names + self.explored if c not in self.dependent)

    def with_numeric(self, cols) -> "FeatureSpec":
        return replace(self, numeric=tuple(cols))

    def model_columns(self) -> tuple[str, ...]:
        """Every column a fitted model reads, key and label first."""
        cols = ([self.key] if self.key else []) + [self.label]
        cols += [c for c in self.numeric + self.ratio_names + self.binary + self.categorical
                 if c not in self.dependent]
        seen, out = set(), []
        for c in cols:
            if c not in seen:
                seen.add(c)
                out.append(c)
        return tuple(out)
