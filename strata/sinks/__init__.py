"""Writers: layer tables, BI export, event publishing with a file fallback, layer publish and
object manifests."""
