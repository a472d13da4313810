"""Column functions: text, HTML and evaluation expressions that stay inside the JVM."""
