"""Part of segtally."""
