"""Column builders: Column in, Column out, evaluated in the JVM unless a module says otherwise."""
