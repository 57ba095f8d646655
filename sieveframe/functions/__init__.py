"""Column builders: text, number and date expressions that stay inside the JVM."""
