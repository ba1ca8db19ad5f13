"""Column expressions: topics, payloads, time, values."""

from .parse import *  # noqa: F401,F403
from .time import *  # noqa: F401,F403
