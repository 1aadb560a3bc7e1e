"""Every query of the core with its DuckDB statement."""

from tallyloom.queries import graphload, pipeline, products, reference, surface

MODULES = (pipeline, reference, products, graphload, surface)
