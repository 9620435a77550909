"""The models. Importing the package registers all of them."""

from learnsilver.plans import bridges, dims, facts, refs, staging  # noqa: F401
from learnsilver.plans.registry import REGISTRY, build_model, layer_of  # noqa: F401
