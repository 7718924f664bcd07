"""Column builders: all return JVM-side expressions, none needs Python workers."""
