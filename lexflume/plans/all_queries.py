"""Every core query; importing a module of this package registers what is in it."""

from lexflume.plans import charts, cleaning, figures, layout, markdown, outcomes, queries, references, repair, reports  # noqa: F401
from lexflume.plans.registry import ORACLES, QUERIES  # noqa: F401
