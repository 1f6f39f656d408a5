"""Column-level building blocks: everything here is Column -> Column and stays in the JVM."""
