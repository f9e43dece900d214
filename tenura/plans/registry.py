"""Which models there are: layer, materialisation, tags and how each is built."""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tenura import specs
from tenura.operators.quality import Check, Observed
from tenura.plans import data_tests as names
from tenura.plans import analytics, features, silver, star
from tenura.sources.tables import Lake

Build = Callable[[Lake], DataFrame]


@dataclass(frozen=True)
class Model:
    """A table or view built from tables that stand earlier in the list."""

    name: str
    build: Build
    tags: frozenset[str]
    materialize: str = "table"

    @property
    def layer(self) -> str:
        return self.name.split(".")[0]


def _clean(lake: Lake) -> DataFrame:
    return lake.read(names.CLEAN)


def stored_dimensions(lake: Lake) -> star.Dimensions:
    return star.Dimensions({name: lake.read(names.DIM.format(name)) for name in star.DIMENSIONS})


def _dimension(name: str) -> Model:
    return Model(
        names.DIM.format(name), lambda lake: star.dimension(_clean(lake), name),
        frozenset({"gold", "star_schema", "dimension"}),
    )


MODELS: list[Model] = [
    Model(names.CLEAN, lambda lake: silver.clean(lake.read(names.RAW)), frozenset({"silver"})),
    Model(names.FEATURES, lambda lake: features.ml_features(_clean(lake), keep=(specs.KEY,)),
          frozenset({"gold", "ml", "features"})),
    Model(names.ANALYTICS, lambda lake: analytics.attrition_analytics(_clean(lake)),
          frozenset({"gold", "analytics"})),
    *[_dimension(name) for name in star.DIMENSIONS],
    Model(names.FACT, lambda lake: star.fact(_clean(lake), stored_dimensions(lake)),
          frozenset({"gold", "star_schema", "fact"})),
]


def build(lake: Lake, tags: Collection[str] | None = None, models: Collection[Model] = MODELS,
          checks: Collection[Check] = ()) -> dict[str, Observed | None]:
    """Build the models with any of the tags, in the listed order; by name, what each write counted.

    Failures of the simple ones of ``checks`` are counted while their table is written.
    """
    done = {}
    for model in models:
        if tags is not None and not model.tags & set(tags):
            continue
        if model.materialize == "view":
            lake.create_view(model.build(lake), model.name)
            done[model.name] = None
        else:
            done[model.name] = lake.write_observed(model.build(lake), model.name, [c for c in checks if c.table == model.name])
    return done
