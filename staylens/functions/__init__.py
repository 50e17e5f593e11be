"""Column expressions (JVM-side, code-generated) used across the operators."""

from staylens.functions.columns import *  # noqa: F401,F403
