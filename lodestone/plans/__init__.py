from . import queries  # noqa: F401  (agent_queries adds to its tables)
from . import agent_queries  # noqa: F401, E402, I001
from . import state_queries  # noqa: F401, E402, I001
from . import text_queries  # noqa: F401, E402, I001
