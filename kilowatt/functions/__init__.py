"""Column expressions (JVM-side, codegen'd) shared by batch and stream code."""

from kilowatt.functions.expressions import *  # noqa: F401,F403
