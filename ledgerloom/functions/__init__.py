"""Column expressions: dates, text, arrays.  All run inside the JVM."""
