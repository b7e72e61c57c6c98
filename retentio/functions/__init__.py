"""``Column`` builders.  All are JVM-side expressions (no Python UDFs)."""
