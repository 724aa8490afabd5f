"""Scalar operators: ``text`` (JVM expressions), ``arrow`` (pandas UDFs), ``constants`` (fixed values)."""
