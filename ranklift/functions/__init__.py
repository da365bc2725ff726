"""Row-wise column expressions. Every function takes and returns ``Column``s."""

from ranklift.functions.scalars import *  # noqa: F401,F403
