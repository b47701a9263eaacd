"""Named products; importing this package registers all of them."""

from . import acoustic, ctd, fish, indices, metadata, taxa, water
from .catalog import PRODUCTS, Catalog
from .pipeline import build

__all__ = ["PRODUCTS", "Catalog", "acoustic", "build", "ctd", "fish", "indices", "metadata", "taxa", "water"]
