from .dictionary import data_dictionary
from .mart import Built, QualityError, build_labels, build_table, run
from .recipes import RECIPES, Recipe

__all__ = ["data_dictionary", "Built", "QualityError", "build_labels", "build_table", "run", "RECIPES", "Recipe"]
