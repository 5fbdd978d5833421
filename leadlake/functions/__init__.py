"""Column -> Column functions; none needs a session, all stay inside the JVM."""
