"""Column expressions shared by builds and reports (all JVM-side, codegen-friendly)."""
