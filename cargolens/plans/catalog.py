"""Imports every query module so that the registry is complete."""

from . import q_sources  # noqa: F401
from . import q_mart  # noqa: F401
from . import q_mart2  # noqa: F401
from . import q_quality  # noqa: F401
from . import q_stats  # noqa: F401
from . import q_features  # noqa: F401
from . import q_eval  # noqa: F401
from . import q_audit  # noqa: F401
from . import q_stream  # noqa: F401
from . import q_drift  # noqa: F401
from . import q_scoring  # noqa: F401
from . import q_models  # noqa: F401

q_quality.register_facts()
