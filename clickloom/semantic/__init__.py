from clickloom.semantic.ratings import RATINGS, rate, with_ratings
from clickloom.semantic.tiles import TILES, run_tile
from clickloom.semantic.view import Dimension, Measure, SemanticView
from clickloom.semantic.views import CHANNEL_ROI, CUSTOMER_ACQUISITION, MARKETING_DASHBOARD, VIEWS

__all__ = [
    "CHANNEL_ROI",
    "CUSTOMER_ACQUISITION",
    "MARKETING_DASHBOARD",
    "RATINGS",
    "TILES",
    "VIEWS",
    "Dimension",
    "Measure",
    "SemanticView",
    "rate",
    "run_tile",
    "with_ratings",
]
